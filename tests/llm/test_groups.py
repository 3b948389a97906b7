"""Operators on pairs, passages and sequences against brute force."""

import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import by_id
from tidemark.llm import exact, near, packing, queries, suffix, warc
from tidemark.llm.storage import table

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def edited(rng, words, share):
    return [w if rng.random() > share else f"n{rng.randrange(10**6)}" for w in words]


def families(seed, groups=6, size=25, noise=60):
    """Texts with near copies of graded similarity, exact copies, a shared passage, and unrelated ones."""
    rng = random.Random(seed)
    word = lambda: f"v{rng.randrange(4000)}"
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randrange(80, 300))]
        for _ in range(size):
            texts.append(" ".join(edited(rng, base, rng.choice([0, 0.002, 0.01, 0.02, 0.04, 0.1]))))
    for _ in range(noise):
        texts.append(" ".join([word() for _ in range(rng.randrange(1, 120))] + passage))
    texts += ["a b c", "A  b\tC", "a b", "", None, "one two three four five"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def brute_near(rows, num, den):
    sets, parent = {}, {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
        parent[i] = i
    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                    x, y = root(i), root(j)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize("small", [near.SMALL, 6])
def test_near_groups_equal_brute_force(docs, monkeypatch, small):
    monkeypatch.setattr(near, "SMALL", small)  # small nodes: also the deeper levels and the block pairs
    rows = families(1)
    got = by_id(near.near_groups(docs(*rows), 85, 100))
    want = brute_near(rows, 85, 100)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


@pytest.mark.parametrize("share", [0.85, 0.8])
def test_pairs_at_the_threshold_meet_at_the_last_level(spark, monkeypatch, share):
    """Families of over 256 sketches with pairs that agree as at the threshold, in the production trees."""
    monkeypatch.setattr(near, "SMALL", 1)  # every node branches on to the last level
    rng, families, size = np.random.default_rng(11), 4, 300
    base = np.repeat(rng.integers(0, 1 << 16, (families, near.SKETCH), np.uint16), size, axis=0)
    own = rng.integers(0, 1 << 16, base.shape, np.uint16)
    sketch = np.where(rng.random(base.shape) < share ** 0.5, base, own)
    rows = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in enumerate(sketch)], "id bigint, sketch binary")
    _, large = near.nodes(rows, 1 / share - 1)
    together = np.zeros((len(sketch), len(sketch)), bool)
    for r in large.groupBy("key").agg({"id": "collect_list"}).collect():
        together[np.ix_(r[1], r[1])] = True
    met = total = 0
    for first in range(0, len(sketch), size):
        own = slice(first, first + size)
        pairs = np.triu((sketch[own, None] == sketch[None, own]).sum(axis=2) >= 0.75 * share * near.SKETCH, 1)
        met, total = met + int(together[own, own][pairs].sum()), total + int(pairs.sum())
    assert total > 170_000 and met >= 0.985 * total


def test_trees_reach_the_recall_at_every_threshold():
    for share in (0.7, 0.8, 0.85, 0.9, 0.95):
        assert near.missed(near.tree_count(share), share) <= 0.01 < near.missed(near.tree_count(share) - 1, share)


def test_a_linked_family_gives_no_block_pairs(docs, monkeypatch):
    monkeypatch.setattr(near, "SMALL", 6)
    frames, plain = {}, near.saved
    monkeypatch.setattr(near, "saved", lambda df, name: frames.setdefault(name, plain(df, name)) if name == "blocks" else plain(df, name))
    rng = random.Random(5)
    base = [f"v{i}" for i in range(400)]
    rows = [(i, " ".join(edited(rng, base, 0.002))) for i in range(120)]
    got = by_id(near.near_groups(docs(*rows), 85, 100))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute_near(rows, 85, 100)
    assert frames["blocks"].count() <= len(rows)  # 120 members in 20 blocks were 2,400 rows a node


def test_small_groups_within_one_component_are_not_compared_again(docs, monkeypatch):
    written = {}

    def kept(df, name, keep=near.saved):
        written[name] = keep(df, name)
        return written[name]

    monkeypatch.setattr(near, "saved", kept)

    def text(tail):
        return " ".join([*(f"w{i}" for i in range(200)), *tail])
    # each of the first is like every other, so the forest links them all; the last ones meet them in some nodes, but are no candidates
    rows = [(i, text([f"x{i}"])) for i in range(6)]
    rows += [(10 + i, text([f"y{i}-{j}" for j in range(160)])) for i in range(40)]
    got = by_id(near.near_groups(docs(*rows)))
    assert {got[i]["component_id"] for i in range(6)} == {0} and all(got[10 + i]["kept"] for i in range(40))
    assert not written["forest"].filter("more and a < 6").isEmpty()
    assert {r["id"] for r in written["labelled"].collect()}.isdisjoint(range(6))


def test_near_groups_of_the_table(spark):
    docs = table(spark, SMALL, "documents")
    got = by_id(near.of_documents(docs))
    want = brute_near([(r["doc_id"], r["text"]) for r in docs.collect()], 85, 100)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = {r["id"]: r["comp"] for r in near.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_groups_are_never_cut():
    import pyarrow as pa
    rng = random.Random(3)
    keys = sorted(rng.choices(range(40), k=500))
    batches, at = [], 0
    while at < len(keys):
        n = rng.randrange(0, 30)
        batches.append(pa.RecordBatch.from_arrays([pa.array(keys[at:at + n], pa.int64())], ["key"]))
        at += n
    seen, total = set(), 0
    for t in near.grouped(iter(batches), "key"):
        mine = set(t["key"].to_pylist())
        assert not mine & seen
        seen |= mine
        total += t.num_rows
    assert total == len(keys)


def test_exact_dedup_equals_sql(spark):
    import verify
    con = verify.connect(SMALL)
    class Check:
        sql = exact.ORACLE
        def __call__(self, session, folder):
            return exact.of_documents(table(session, folder, "documents"))
    assert verify.compare(con, spark, Check(), SMALL).startswith("ok")


def test_exact_dedup_of_odd_rows(docs):
    rows = docs((1, "Ab É"), (2, "aB É"), (3, "ab é"), (4, None), (5, ""), (6, "x"), (6, "x"), (None, "y"), (None, "Y"), (7, "z"))
    got = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact.of_documents(rows).collect()]
    assert sorted(g for g in got if g[0] in (1, 2, 3, 4, 5, 7)) == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 5, 2, False),
                                                                  (5, 5, 2, True), (7, 7, 1, True)]
    assert sorted(g[3] for g in got if g[0] == 6) == [False, True] and sorted(g[3] for g in got if g[0] is None) == [False, True]
    stay = exact.drop_duplicates(rows)
    assert stay.columns == rows.columns and stay.count() == 6


def test_full_filter_only_sends_more_rows(docs, monkeypatch):
    from tidemark.llm import bloom
    monkeypatch.setattr(bloom, "BUCKET", 8)
    rows = [(i, f"text {i % 150}") for i in range(300)]
    got = by_id(exact.of_documents(docs(*rows)))
    assert all(r["group_size"] == 2 and r["kept"] == (i >= 150) for i, r in got.items())


def brute_repeats(rows):
    first = {}
    for i, text in sorted(rows):
        for p in range(len(text) - 49):
            first.setdefault(text[p:p + 50], i)
    out = {}
    for i, text in rows:
        gone = np.zeros(len(text) + 2, bool)
        for p in range(len(text) - 49):
            if first[text[p:p + 50]] < i:
                gone[p + 1:p + 51] = True
        left = bytes(np.frombuffer(text, np.uint8)[~gone[1:-1]])
        out[i] = len(text), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(left).hexdigest()
    return out


def passages(seed):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice("abcdefgh ijé中") for _ in range(n))
    shared = [make(n) for n in (49, 50, 51, 60, 90, 200, 700)]
    texts = ["".join(rng.choice([make(rng.randrange(80)), rng.choice(shared), rng.choice(shared)[rng.randrange(30):]])
                     for _ in range(rng.randrange(1, 8))) for _ in range(120)]
    return list(enumerate([*texts, "a" * 300, "a" * 120, "ab" * 200, "ab" * 90, "x", "", texts[0], texts[3] * 2]))


@pytest.mark.parametrize("hot", [suffix.HOT, 5])
def test_repeats_equal_brute_force(docs, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT", hot)
    rows = passages(1)
    got = by_id(suffix.of_documents(docs(*rows)))
    want = brute_repeats([(i, t.encode()) for i, t in rows])
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == want


def test_a_hot_string_is_not_sorted_in_one_task(docs, monkeypatch):
    """One passage between different surroundings: no key brings over HOT rows to a sort."""
    monkeypatch.setattr(suffix, "HOT", 20)
    rng = random.Random(7)
    make = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passage = make(70)
    rows = [(i, make(100) + passage + make(100)) for i in range(200)]
    source = docs(*rows)
    keyed, plain = [], type(source).mapInArrow
    monkeypatch.setattr(type(source), "mapInArrow", lambda self, *a, **b: ("key" in self.columns and keyed.append(self)) or plain(self, *a, **b))
    got = by_id(suffix.of_documents(source))
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == brute_repeats([(i, t.encode()) for i, t in rows])
    assert got[199]["n_removed"] >= 70 and keyed
    assert all(r["count"] <= suffix.HOT for frame in keyed for r in frame.groupBy("key").count().collect())


def test_halves_of_blocks_are_not_tested_one_by_one_against_a_filter(docs, monkeypatch):
    """A filter's row of bits for each half of a block filled an executor's memory."""
    seen, plain = [], suffix.among
    monkeypatch.setattr(suffix, "among", lambda rows, *a, **b: seen.append(rows.columns) or plain(rows, *a, **b))
    monkeypatch.setattr(suffix, "HOT", 5)
    rows = passages(2)
    got = by_id(suffix.of_documents(docs(*rows)))
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == brute_repeats([(i, t.encode()) for i, t in rows])
    assert seen and not any("content" in columns for columns in seen)


def test_context_filter_stays_within_its_bound(docs, monkeypatch):
    monkeypatch.setattr(suffix, "MAX_BITS", 24_576)
    rows = passages(2)
    found = suffix.repeated_contexts(docs(*rows))
    assert 8 * len(found.bits) == found.buckets * found.slice_bits <= suffix.MAX_BITS
    got = by_id(suffix.of_documents(docs(*rows)))
    assert {i: r["n_removed"] for i, r in got.items()} == {i: w[1] for i, w in brute_repeats([(i, t.encode()) for i, t in rows]).items()}


def test_repeats_of_the_table(spark):
    docs = table(spark, SMALL, "documents")
    got = by_id(suffix.of_documents(docs))
    want = brute_repeats([(r["doc_id"], r["text"].encode()) for r in docs.collect()])
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == want


def test_suffix_ranks_are_in_order():
    rng = random.Random(2)
    for need in (3, 4, 9, 17, 50):
        for n in (1, 2, 3, 4, 5, 8, 40, 300):
            for letters in (1, 2, 6):
                t = np.array([rng.randrange(1, letters + 1) for _ in range(n)], np.int64)
                order = np.argsort(suffix.suffix_ranks(t, need), kind="stable")
                prefixes = [tuple(t[i:i + need]) for i in order]
                assert prefixes == sorted(prefixes)


def test_repeats_leave_valid_text(docs):
    a = "é" * 40 + "x" * 3
    got = by_id(suffix.without_repeats(docs((1, a), (2, "b" + a + "中c"), (3, None))))
    assert got[1]["text"] == a and got[2]["text"] == "b中c" and got[3]["text"] is None


def test_packing_covers_every_token(spark):
    docs = table(spark, SMALL, "documents")
    capacity = 512
    rows = packing.of_documents(docs, queries.WORD_BPE, 1, capacity).collect()
    plain = Tokenizer.from_file(queries.WORD_BPE)
    by_doc, filled = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], {})[r["piece"]] = r
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for d in docs.collect():
        ids = np.array([*plain.encode(d["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        pieces = by_doc[d["doc_id"]]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            r = pieces.pop(k)
            assert (r["start"], r["length"], r["ids_crc32"]) == (at, len(part), zlib.crc32(part.tobytes()))
        assert not pieces
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(filled) <= 1.02 * sum(r["length"] for r in rows) / capacity + 1


def test_two_smaller_pieces_replace_one():
    bins, offsets = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)  # greedy: 6+3, 2+2; better: 6+2+2, 3
    assert sorted(np.bincount(bins, weights=[6, 3, 2, 2]).tolist()) == [3, 10]


def test_revisits_equal_sql(spark, tmp_path):
    import verify
    from pyspark.sql import functions as F
    pages = table(spark, SMALL, "pages")
    odd = spark.createDataFrame([(90_001, "u", None), (90_002, "u\r\nv", "a\r\n\r\nWARC/1.1\r\nx" * 100), (90_003, None, "a\r\n\r\nWARC/1.1\r\nx" * 100),
                                 (90_004, "u", "x" * 999), (90_005, "u", "x" * 999), (90_006, "u", "é" * 500), (90_007, "u", "é" * 500)], pages.schema)
    both = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 1000)).unionByName(odd)
    both.toPandas().to_parquet(tmp_path / "pages.parquet")
    con = verify.connect(SMALL)
    con.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet'")
    class Check:
        sql = warc.ORACLE
        def __call__(self, session, folder):
            return warc.of_pages(both)
    assert verify.compare(con, spark, Check(), SMALL).startswith("ok")


def test_archives_are_cut_by_their_headers():
    with pytest.raises(ValueError):
        list(warc.parse(b"HTTP/1.1\r\n\r\n"))
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\n\r\n\r\nWARC/\r\n\r\n"
    assert [block for _, block in warc.parse(record * 2)] == [b"\r\n\r\nWARC/"] * 2
