"""Near-duplicate groups of embeddings: spherical k-means cells, blocked cosine products within cells.

1. Equal vectors form a class; the rest works on classes, each with the number of its rows. Vectors of
   different lengths are never compared: each length has a root cell of its own.
2. A cell with more than ``LEAF`` vectors is split by spherical k-means, fitted in a task on about
   ``SAMPLE`` of its vectors (the bound of the index); all its vectors are assigned. Each lives in the cell
   of the nearest centroid, its home, and visits those before it in order that it nearly reaches: the ones
   whose dividing plane is within ``reach`` of it. So a pair meets in at most one cell, that of the first
   of its two homes. A pair at the threshold is missed only if its difference, mostly across the plane,
   goes further than that. Up to 6 components the reach is the sine of the angle, and nothing is missed;
   beyond, it is 2.5 standard deviations of a difference in a random direction, ``LEAST_REACH`` at least.
   The tests measure the recall against brute force.
3. A split that the sample shows not to spare work (a cell of vectors that are all alike) is not made. Cells
   are dealt into blocks by a hash, and each pair of blocks is one matrix product in double precision. Links
   are counted there; of the links themselves only a spanning forest leaves a task.
4. The forests' components are the groups; the smallest id of a group is its representative.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, are linked
with nothing, and so are rows with a null id (their component is null, they are kept); repeated rows are
linked with each other and share their component; ids are integers; other columns are not looked at; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.graph import components
from tidemark.llm.storage import parallelism, saved

LEAST = 0.9
LEAF, BLOCK = 1024, 2048
BRANCH, SAMPLE, ROUNDS, DEPTH = 128, 8192, 8, 8
LEAST_REACH = 0.1
CHUNK = 1 << 16
ROWS = 1024
WORTH = 0.6


def unit(rows: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """The vectors of a column of raw bytes, all of one length, scaled to length 1 in double precision."""
    found = np.frombuffer(b"".join(rows.to_pylist()), kind).reshape(len(rows), -1).astype(np.float64)
    found = found / np.abs(found).max(axis=1, keepdims=True)
    return found / np.sqrt((found * found).sum(axis=1, keepdims=True))


def _usable(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors can be compared, and the length of each."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()  # leaves out what null lists hold
    bad = ~np.isfinite(pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False))
    some = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False) != 0
    ends = np.cumsum(sizes)
    count = lambda flags: np.diff(np.concatenate([[0], np.concatenate([[0], np.cumsum(flags)])[ends]]))
    return (count(bad) == 0) & (count(some) > 0), sizes


def vectors(table: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """(id, dim, vec) with the raw bytes of usable vectors, others null; and the numpy type of a component."""
    single = table.schema[vec_col].dataType == T.ArrayType(T.FloatType(), table.schema[vec_col].dataType.containsNull)
    kind, element = ("<f4", "float") if single else ("<f8", "double")
    source = table.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vec_col}`").cast(f"array<{element}>").alias("vec"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vec")
            good, sizes = _usable(column)
            flat = pc.fill_null(column.flatten(), 0).to_numpy(zero_copy_only=False).astype(kind, copy=False).tobytes()
            width = np.dtype(kind).itemsize
            ends = np.cumsum(sizes) * width
            rows = [flat[e - s * width:e] if ok else None for ok, s, e in zip(good.tolist(), sizes.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int32()), pa.array(rows, pa.binary())], ["id", "dim", "vec"])

    return source.mapInArrow(run, "id bigint, dim int, vec binary"), kind


def reach(dim: int, least: float) -> float:
    """How far beyond a dividing plane a vector's neighbours are looked for."""
    spread = 2.5 * np.sqrt((2 - 2 * least) / dim)
    return float(min(np.sqrt(1 - least * least) + 1e-9, max(LEAST_REACH, spread)))


def visits(sims: np.ndarray, centroids: np.ndarray, home: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector, and flags of the other cells that it visits.

    A vector at home in the cell visits cells before its own only; a visitor goes wherever it may be near.
    """
    best = sims.argmax(axis=1)
    apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * centroids @ centroids.T))[best]
    near = sims.max(axis=1, keepdims=True) - sims <= reach(centroids.shape[1], least) * apart
    near &= ~home[:, None] | (np.arange(len(centroids)) < best[:, None])
    near[np.arange(len(best)), best] = False
    return best, near


def fit(sample: np.ndarray, home: np.ndarray, cells: int, least: float) -> np.ndarray | None:
    """Centroids by spherical k-means; None if they would not spare much of the cell's products."""
    rng = np.random.default_rng(len(sample))
    centroids = np.unique(sample[rng.permutation(len(sample))[:cells]], axis=0)
    for _ in range(ROUNDS):
        best = (sample @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, best, sample)
        size = np.sqrt((sums * sums).sum(axis=1))
        centroids = sums[size > 1e-9] / size[size > 1e-9, None]
    if len(centroids) < 2:
        return None
    best, near = visits(sample @ centroids.T, centroids, home, least)
    living = np.bincount(best[home], minlength=len(centroids))
    visiting = near.sum(axis=0) + np.bincount(best[~home], minlength=len(centroids))
    whole = home.sum() ** 2 / 2 + home.sum() * (~home).sum()
    return centroids if (living ** 2 / 2 + living * visiting).sum() <= WORTH * whole else None


def _centroids(large: DataFrame, kind: str, least: float) -> DataFrame:
    """(cell, centroids) of the cells worth splitting; rows are (cell, node, home, vec, size, homes)."""
    share = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1 << 30)) < F.ceil(F.lit(float(SAMPLE)) / F.col("size") * (1 << 30))

    def run(rows: pa.Table) -> pa.Table:
        cells = min(BRANCH, int(np.ceil(1.5 * rows["homes"][0].as_py() / LEAF)))
        found = fit(unit(rows["vec"], kind), rows["home"].to_numpy(), max(2, cells), least)
        return pa.table({"cell": rows["cell"][:found is not None], "centroids": pa.array([] if found is None else [found.tobytes()], pa.binary())})

    return large.filter(share).select("cell", "home", "vec", "homes").groupBy("cell").applyInArrow(run, "cell string, centroids binary")


def _children(large: DataFrame, centroids: DataFrame, kind: str, least: float) -> DataFrame:
    """(cell, node, home, n, vec) one level below. A cell's rows are dealt to tasks in chunks, each behind the centroids."""
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    body = large.select("cell", F.pmod(F.xxhash64("node", F.lit(4)), chunks).cast("int").alias("chunk"), "node", "home", "n", "vec")
    sizes = large.select("cell", "size").distinct()
    heads = centroids.join(sizes, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), F.lit(None).cast("bigint").alias("node"),
        F.lit(False).alias("home"), F.lit(0).cast("bigint").alias("n"), F.col("centroids").alias("vec"))
    both = heads.unionByName(body).repartition(parallelism(large.sparkSession), "cell", "chunk").sortWithinPartitions("cell", "chunk", F.asc_nulls_first("node"))

    def assign(rows: pa.RecordBatch, centroids: np.ndarray, cell: str) -> pa.RecordBatch:
        home = rows.column("home").to_numpy(zero_copy_only=False)
        best, near = visits(unit(rows.column("vec"), kind) @ centroids.T, centroids, home, least)
        row, child = np.nonzero(near)
        row, child = np.concatenate([np.arange(len(best)), row]), np.concatenate([best, child])
        lives = np.concatenate([home, np.zeros(len(row) - len(best), bool)])
        took = rows.take(pa.array(row))
        names = pa.array([f"{cell}/{c}" for c in range(len(centroids))]).take(pa.array(child))
        return pa.RecordBatch.from_arrays([names, took.column("node"), pa.array(lives), took.column("n"), took.column("vec")], ["cell", "node", "home", "n", "vec"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = held = None
        for batch in batches:
            head = np.flatnonzero(pc.is_null(batch.column("node")).to_numpy(zero_copy_only=False)).tolist()
            for first, last in zip([0, *head], [*head, batch.num_rows]):
                if first == last:
                    continue
                part = batch.slice(first, last - first)
                if first in head:
                    cell, held = part.column("cell")[0].as_py(), np.frombuffer(part.column("vec")[0].as_py(), np.float64)
                    part = part.slice(1)
                for at in range(0, part.num_rows, ROWS):
                    rows = part.slice(at, ROWS)
                    dim = len(rows.column("vec")[0].as_py()) // np.dtype(kind).itemsize
                    yield assign(rows, held.reshape(-1, dim), cell)

    return both.mapInArrow(run, "cell string, node bigint, home boolean, n bigint, vec binary")


def cells(classes: DataFrame, kind: str, least: float) -> DataFrame:
    """(cell, node, home, n, vec, size, homes) of all cells that are not split any more."""
    members = classes.select(F.col("dim").cast("string").alias("cell"), "node", F.lit(True).alias("home"), "n", "vec")
    done = None
    for depth in range(DEPTH + 1):
        homes = F.sum(F.col("home").cast("bigint")).alias("homes")
        sized = members.join(saved(members.groupBy("cell").agg(F.count("*").alias("size"), homes), "sizes"), "cell").filter("homes > 0")
        large = sized.filter(F.col("homes") > LEAF)
        split = None
        if depth < DEPTH and not large.isEmpty():
            split = saved(_centroids(large, kind, least), "centroids")
            split = None if split.isEmpty() else split
        rest = sized if split is None else sized.join(split.select("cell"), "cell", "left_anti")
        rest = rest.select("cell", "node", "home", "n", "vec", "size", "homes")
        done = rest if done is None else done.unionByName(rest)
        if split is None:
            return done
        members = saved(_children(sized.join(split.select("cell"), "cell", "left_semi"), split, kind, least), "members")


def compare(found: DataFrame, kind: str, least: float) -> DataFrame:
    """(node, other, n): links of each vector as a sum of n, and edges of a spanning forest (other not null).

    Blocks of vectors at home come first in a cell's numbering, then those of visitors, which meet only the former.
    """
    living, visiting = F.ceil(F.col("homes") / BLOCK).cast("int"), F.ceil((F.col("size") - F.col("homes")) / BLOCK).cast("int")
    number = F.xxhash64("node", F.lit(5))
    block = F.when(F.col("home"), F.pmod(number, living)).otherwise(living + F.pmod(number, F.greatest(visiting, F.lit(1)))).cast("int")
    last = F.when(F.col("home"), living + visiting - 1).otherwise(living - 1)
    pairs = found.select("*", block.alias("block"), F.explode(F.sequence(F.lit(0), last)).alias("other")).select(
        "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "n", "vec",
        (F.col("block") <= F.col("other")).alias("left"), (F.col("block") >= F.col("other")).alias("right"))

    def run(rows: pa.Table) -> pa.Table:
        left, right = rows["left"].to_numpy(), rows["right"].to_numpy()
        node, weight, at = rows["node"].to_numpy(), rows["n"].to_numpy(), unit(rows["vec"], kind)
        a, b = np.flatnonzero(left), np.flatnonzero(right)
        near = at[a] @ at[b].T >= least
        if left.all() and right.all():  # one block with itself: each link stands there twice
            np.fill_diagonal(near, False)
        else:
            both = near.any(axis=1), near.any(axis=0)
            near, a, b = near[both[0]][:, both[1]], a[both[0]], b[both[1]]
        links = np.zeros(len(node), np.int64)
        links[a] += near @ weight[b]
        if not (left.all() and right.all()):
            links[b] += near.T @ weight[a]
        some = np.flatnonzero(links)
        place = np.zeros(len(node), np.int64)
        place[some] = np.arange(len(some))
        linked = near.any(axis=1), near.any(axis=0)
        whole = np.zeros((len(some), len(some)), bool)
        whole[np.ix_(place[a[linked[0]]], place[b[linked[1]]])] = near[linked[0]][:, linked[1]]
        one, two = _forest(whole | whole.T)
        return pa.table({"node": np.concatenate([node[some], node[some[one]]]), "other": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(node[some[two]])]),
                         "n": np.concatenate([links[some], np.zeros(len(one), np.int64)])})

    return pairs.groupBy("cell", "i", "j").applyInArrow(run, "node bigint, other bigint, n bigint")


def _forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what a symmetric matrix of flags connects, one less than members of each group."""
    open_, one, two = near.any(axis=1), [], []
    for start in np.flatnonzero(open_).tolist():
        if not open_[start]:
            continue
        open_[start] = False
        front = np.array([start])
        while len(front):
            front = np.flatnonzero(near[front].any(axis=0) & open_)
            open_[front] = False
            one.append(np.full(len(front), start))
            two.append(front)
    return (np.concatenate(one), np.concatenate(two)) if one else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def near_groups(table: DataFrame, least: float = LEAST, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, n_links, component_id and kept of every row; linked if the cosine is at least ``least``."""
    found, kind = vectors(table, id_col, vec_col)
    found = saved(found, "vectors")
    classes = found.filter("vec is not null and id is not null").groupBy("dim", "vec").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    classes = saved(classes.select(F.monotonically_increasing_id().alias("node"), "dim", "vec", "n", "low"), "classes")
    links = saved(compare(cells(classes, kind, least), kind, least), "links")
    comps = saved(components(links.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))), "comps")
    counts = links.filter("n > 0").groupBy("node").agg(F.sum("n").alias("links"))
    with_comp = saved(classes.join(counts, "node", "left").join(comps.withColumnRenamed("id", "node"), "node", "left").select(
        "vec", "low", (F.coalesce("links", F.lit(0).cast("bigint")) + F.col("n") - 1).alias("n_links"), F.coalesce("comp", "node").alias("comp")), "numbered")
    lowest = saved(with_comp.groupBy("comp").agg(F.min("low").alias("component_id")), "lowest")
    named = saved(with_comp.join(lowest, "comp").select(F.col("vec").alias("__vec"), "n_links", "component_id"), "named")
    joined = found.join(named, (F.col("vec") == F.col("__vec")) & F.col("id").isNotNull(), "left")
    component = F.coalesce("component_id", "id")
    return joined.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
                         component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def of_embeddings(table: DataFrame) -> DataFrame:
    """Every vector's links and group at a cosine of 0.9."""
    return near_groups(table)


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
     u AS (SELECT vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                                     AND len(list_filter(e, lambda x: x <> 0)) > 0),
     l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
     r AS (SELECT vec_id AS id, vec_id AS reached FROM v UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.reached),
     c AS (SELECT id, min(reached) AS component_id FROM r GROUP BY id),
     n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c ON c.id = vec_id LEFT JOIN n ON n.a = vec_id"""
