"""Embedding groups against brute force."""

import numpy as np
import pytest

from tests.llm.conftest import by_id
from tidemark.llm import embeddings as E
from tidemark.llm.storage import table

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, least=0.9):
    """Links and groups by all products of rows with distinct ids."""
    ok = [(i, np.array(v, float)) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    found = {i: (0, i) for i, _ in rows}
    for dim in {len(v) for _, v in ok}:
        ids = np.array([i for i, v in ok if len(v) == dim])
        x = np.array([v for _, v in ok if len(v) == dim])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= least
        comp = ids.copy()
        while True:
            low = np.array([comp[row].min() for row in near])
            if (low == comp).all():
                break
            comp = low
        found |= {int(i): (int(n), int(c)) for i, n, c in zip(ids, near.sum(axis=1) - 1, comp)}
    return found


def families(seed, noise, groups, size, dim, spread):
    rng = np.random.default_rng(seed)
    x = [rng.normal(size=(noise, dim))]
    for _ in range(groups):
        x.append(rng.normal(size=dim) + rng.normal(size=(size, dim)) * spread * rng.random((size, 1)))
    x = np.concatenate(x).astype(np.float32)
    return [(k, v.tolist()) for k, v in zip(rng.permutation(len(x)).tolist(), x)]


def got(spark, rows, schema=SCHEMA):
    return {i: (r["n_links"], r["component_id"]) for i, r in by_id(E.of_embeddings(spark.createDataFrame(rows, schema)), "vec_id").items()}


def test_one_cell_equals_brute_force(spark):
    rows = families(1, 200, 10, 30, 16, 0.5)
    rows += [(1000, rows[0][1]), (1001, rows[0][1]), (1002, None), (1003, []), (1004, [0.0] * 16), (1005, [1.0, None]), (1006, [float("nan")] * 16),
             (1007, [float("inf")] * 16), (1008, [1.0, 2.0]), (1009, [2.0, 4.0]), (1010, [1e30, 2e30]), (1011, [1e-40, 2e-40])]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("dim", [8, 64])
def test_recall_over_many_cells(spark, monkeypatch, dim):
    """Cells of several levels, blocks, and a large group; every link counted is real."""
    monkeypatch.setattr(E, "LEAF", 100)
    monkeypatch.setattr(E, "BLOCK", 60)
    monkeypatch.setattr(E, "BRANCH", 8)
    rows = families(2, 1500, 25, 20, dim, 0.45) + [(i + 10_000, v) for i, v in families(3, 0, 1, 700, dim, 0.5)]
    found, want = got(spark, rows), brute(rows)
    links, all_links = (sum(n for n, _ in f.values()) for f in (found, want))
    assert all(found[i][0] <= want[i][0] for i in want)
    assert all(want[c] == want[i] or want[i][1] == want[c][1] for i, (_, c) in found.items())
    assert links >= 0.97 * all_links
    assert sum(found[i][1] == want[i][1] for i in want) >= 0.97 * len(want)


def test_double_vectors_null_ids_repeated_rows_and_clashes(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", *[f"'x' {c}" for c in ("id", "vec", "n", "node", "cell", "dim", "low")])
    out = sorted(map(tuple, E.of_embeddings(df).collect()), key=str)
    assert out == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 0, None, True), (2, 2, 1, False), (3, 0, 3, True)], key=str)
    assert E.of_embeddings(spark.createDataFrame([], SCHEMA)).collect() == []


def test_whole_table(spark):
    t = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [tuple(r) for r in t.select("vec_id", "embedding").collect()]
    assert {i: (r["n_links"], r["component_id"]) for i, r in by_id(E.of_embeddings(t), "vec_id").items()} == brute(rows)


def test_forest_connects_what_is_connected():
    rng = np.random.default_rng(4)
    for _ in range(50):
        near = rng.random((12, 12)) < 0.12
        near |= near.T
        np.fill_diagonal(near, False)
        one, two = E._forest(near)
        part = np.arange(12)
        for a, b in zip(one, two):
            part[part == part[b]] = part[a]
        reach = np.linalg.matrix_power((near | np.eye(12, dtype=bool)).astype(float), 12) > 0
        assert all((part[i] == part[j]) == reach[i, j] for i in range(12) for j in range(12))
