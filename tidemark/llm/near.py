"""Near-duplicate groups by a chosen-path set similarity join.

A text's set holds its distinct shingles of five lower-cased words. Two texts are linked if the Jaccard
similarity of their full sets reaches the threshold; a group is what links connect.

1. Texts with equal sets form a class with one representative; the rest works on representatives.
2. Each has a sketch of ``SKETCH`` minwise hashes. Independent trees branch the representatives: a node
   (named by the path of chosen tokens) picks one sketch coordinate, and a second one with a probability
   that makes a pair at the threshold share one child a level on average; a representative follows the
   minwise tokens it has there. A path depends on the text alone, so ``LEVELS`` levels are taken at once.
3. Nodes of at most ``SMALL`` members are compared exhaustively; larger ones branch on, down to
   ``DEPTH`` levels, where what is still large is compared block by block. Comparison uses the sketches
   and leaves out pairs whose estimate is far below the threshold (3 standard deviations).
4. A spanning forest of each node's candidate pairs is confirmed on the full sets first; its links are
   contracted to components (alternating large-star and small-star steps). Nodes whose forest still joins
   several components give the remaining candidates between them. So pairs within a group are never all emitted.

The number of trees follows from the threshold: a pair at the threshold that must go down to level
``DEPTH`` is found with a probability of ``RECALL``, and closer pairs more surely. All trees read the same
sketch, so the probability is the mean over what the sketches of such a pair agree in (``missed``).

Defined results: null and empty texts, and texts without words, have no shingles and are linked with
nothing; fewer than five words are one shingle; rows with a null id are linked with nothing and kept, and
their component is null; repeated rows share their component; ids are integers; columns other than id
and text are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import arrays as A
from tidemark.llm.bloom import among, without
from tidemark.llm.graph import components, extended
from tidemark.llm.storage import parallelism, saved

WORDS = 5
SKETCH = 128
RECALL = 0.99
LEVELS, DEPTH = 3, 12
SMALL = 256
_rng = np.random.default_rng(20240229)
_FLIP = _rng.integers(0, 1 << 32, SKETCH, np.uint32)
_TIMES = _rng.integers(0, 1 << 32, SKETCH, np.uint32) | np.uint32(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text of a block."""
    lower = A.LOWER[data]
    w = A.words(lower, offsets)
    hashes = A.span_hashes(lower, w.starts, w.ends)
    runs, sets = A.rolling(hashes, WORDS), []
    for first, last in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if last - first >= WORDS:
            sets.append(np.unique(runs[first:last - WORDS + 1]))
        else:
            sets.append(A.rolling(hashes[first:last], last - first) if last > first else hashes[:0])
    return sets


def _sketches(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Minwise hashes (16 bits each) of sets that lie one after the other; none of them is empty."""
    x = (values >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(first), SKETCH), np.uint16)
    for k in range(SKETCH):
        low = np.minimum.reduceat((x ^ _FLIP[k]) * _TIMES[k], first)
        out[:, k] = (low * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


def features(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n_shingles, a 128-bit digest of the set (null for empty sets) and its sketch."""
    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        A.release()
        for batch in batches:
            for part, data, offsets in A.blocks(batch.column("text")):
                sets = shingle_sets(data, offsets)
                n = np.array([len(s) for s in sets])
                full, values = np.flatnonzero(n), np.concatenate(sets)
                one, two, sketch = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), [None] * len(n)
                if len(full):
                    first = np.concatenate([[0], np.cumsum(n[full])[:-1]])
                    one[full] = np.add.reduceat(A.mix(values.copy()), first).astype(np.int64)
                    two[full] = np.add.reduceat(A.mix(values ^ A.U(0x5851F42D4C957F2D)), first).astype(np.int64)
                    for at, row in zip(full.tolist(), _sketches(values, first)):
                        sketch[at] = row.tobytes()
                empty = n == 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(part.start, len(n)), pa.array(n), pa.array(one, mask=empty), pa.array(two, mask=empty),
                     pa.array(sketch, pa.binary())], ["id", "n", "one", "two", "sketch"])

    return source.mapInArrow(run, "id bigint, n bigint, one bigint, two bigint, sketch binary")


def _least(share: float) -> int:
    """The fewest equal coordinates with which a pair of sketches is a candidate."""
    return int(np.ceil(SKETCH * (share - 3.0 * np.sqrt(share * (1 - share) / SKETCH))))


def missed(trees: int, share: float) -> float:
    """Probability that a pair of this similarity, also the threshold, shares no node at level ``DEPTH`` or is no candidate."""
    total = 0.0
    for equal in range(SKETCH + 1):
        weight = comb(SKETCH, equal) * share ** equal * (1 - share) ** (SKETCH - equal)
        agree, gone = equal / SKETCH, 0.0
        for _ in range(DEPTH):  # a node's children: the first token always, the second with its probability
            gone = (1 - agree * (1 - gone)) * (1 - (1 / share - 1) * agree * (1 - gone))
        total += weight * (gone ** trees if equal >= _least(share) else 1.0)
    return total


@cache
def tree_count(share: float) -> int:
    """The fewest trees that miss at most ``1 - RECALL`` of the pairs at this threshold, the cut by the sketches included."""
    return next(t for t in range(1, 1 << 10) if missed(t, share) <= 1 - RECALL)


def _branch(sketch: np.ndarray, row: np.ndarray, key: np.ndarray, levels: int, second: float) -> tuple[np.ndarray, np.ndarray]:
    """Follow paths for some levels; ``row`` names the sketch of each path, ``key`` the node it is in."""
    for _ in range(levels):
        rows, keys = [], []
        for turn, share in ((1, 1.0), (2, second)):
            drawn = A.mix(key ^ A.U(0x632BE59BD9B4E019 * turn % (1 << 64)))
            go = (A.mix(drawn + A.U(1)) >> A.U(11)).astype(float) / (1 << 53) < share
            at = (drawn[go] & A.U(SKETCH - 1)).astype(np.int64)
            token = (at.astype(A.U) << A.U(16)) | sketch[row[go], at].astype(A.U)
            rows.append(row[go])
            keys.append(A.mix(key[go] * A.U(0x9FB21C651E98DF25) + A.mix(token + A.U(1))))
        row, key = np.concatenate(rows), np.concatenate(keys)
    return row, key


def _sketch_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SKETCH)


def _grow(rows: DataFrame, second: float, trees: int = 0) -> DataFrame:
    """(key, id) of the nodes ``LEVELS`` below; rows have id and sketch, and a key unless ``trees`` start here."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 8192):
                part = batch.slice(first, 8192)
                sketch = _sketch_rows(part.column("sketch"))
                row = np.arange(len(sketch))
                if trees:
                    key = np.repeat(A.mix(np.arange(1, trees + 1).astype(A.U)), len(sketch))
                    row = np.tile(row, trees)
                else:
                    key = part.column("key").to_numpy().astype(A.U)
                row, key = _branch(sketch, row, key, LEVELS, second)
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), part.column("id").take(pa.array(row))], ["key", "id"])

    return rows.mapInArrow(run, "key bigint, id bigint")


def _members(rows: DataFrame) -> DataFrame:
    """(key, id, size) of the nodes with two members or more."""
    rows = saved(rows.distinct(), "paths")
    sizes = saved(rows.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
    return rows.join(sizes, "key")


def nodes(reps: DataFrame, second: float) -> tuple[DataFrame, DataFrame]:
    """(key, id) of the small nodes, and of the large ones left at the last level."""
    members = saved(_members(_grow(reps.select("id", "sketch"), second, tree_count(1 / (1 + second)))), "nodes")
    small = members.filter(F.col("size") <= SMALL)
    for _ in range(LEVELS, DEPTH, LEVELS):
        large = members.filter(F.col("size") > SMALL).select("key", "id")
        if large.isEmpty():
            break
        below = _grow(large.join(reps.select("id", "sketch"), "id"), second)
        members = saved(_members(below), "nodes")
        small = small.unionByName(members.filter(F.col("size") <= SMALL))
    return small.select("key", "id"), members.filter(F.col("size") > SMALL).select("key", "id", "size")


def grouped(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.Table]:
    """Re-cut sorted batches so that no group (run of equal ``name``) is split; groups are bounded."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(name).to_numpy()
        if not len(keys):
            continue
        begin = int(np.searchsorted(keys != keys[-1], False)) if keys[0] != keys[-1] else 0
        if begin:
            begin = int(np.flatnonzero(keys != keys[-1])[-1]) + 1
        elif held and held[-1].column(name)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        if begin:
            yield pa.Table.from_batches([*held, batch.slice(0, begin)])
            held = [batch.slice(begin)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _by_group(rows: DataFrame, name: str) -> DataFrame:
    return rows.repartition(parallelism(rows.sparkSession), name).sortWithinPartitions(name)


def _pairs(keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (i < j) of rows with equal keys, a bounded number at a time; keys are sorted."""
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    ends = np.repeat(np.append(heads[1:], len(keys)), np.diff(np.append(heads, len(keys))))
    left = ends - np.arange(len(keys)) - 1
    upto = np.cumsum(left)
    first = 0
    while first < len(keys):
        last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + 40_000, "right")))
        n = left[first:last]
        i = np.repeat(np.arange(first, last), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        if len(i):
            yield i, j
        first = last


def _root(parent: dict[int, int], x: int) -> int:
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _alike(table: pa.Table, num: int, den: int, across: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of one group whose sketches may reach the threshold, and their agreement.

    ``across``: only pairs of different components. Pairs of one side of a pair of blocks are left out.
    """
    least = _least(num / den)
    ids, n, comp, side = (table[c].to_numpy() for c in ("id", "n", "comp", "side"))
    sketch = _sketch_rows(table["sketch"].combine_chunks())
    found = [np.zeros((3, 0), np.int64)]
    for i, j in _pairs(table["key"].to_numpy()):
        good = (np.minimum(n[i], n[j]) * den >= np.maximum(n[i], n[j]) * num) & (ids[i] != ids[j])
        good &= comp[i] != comp[j] if across else True
        good &= (side[i] != side[j]) | (side[i] < 0)
        i, j = i[good], j[good]
        alike = (sketch[i] == sketch[j]).sum(axis=1)
        ok = alike >= least
        found.append(np.stack([i[ok], j[ok], alike[ok]]))
    i, j, alike = np.concatenate(found, axis=1)
    return i, j, alike


def forest(rows: DataFrame, num: int, den: int) -> DataFrame:
    """A spanning forest (a < b, key) of each group's candidates, the most alike first.

    ``more`` says that the group has candidates beside the forest. Rows are (key, id, n, sketch, comp, side).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, "key"):
            key, ids = table["key"].to_numpy(), table["id"].to_numpy()
            i, j, alike = _alike(table, num, den, across=False)
            order = np.lexsort((-alike, key[i]))
            i, j = i[order], j[order]
            take, parent, extra = [], {}, set()
            for at, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
                x, y = _root(parent, x), _root(parent, y)
                if x != y:
                    parent[x] = y
                    take.append(at)
                else:
                    extra.add(int(key[i[at]]))
            i, j = i[take], j[take]
            more = np.isin(key[i], np.array(sorted(extra), np.int64))
            a, b = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(key[i]), pa.array(more)], ["a", "b", "key", "more"])

    return _by_group(rows, "key").mapInArrow(run, "a bigint, b bigint, key bigint, more boolean")


def crossings(rows: DataFrame, num: int, den: int) -> DataFrame:
    """(key, id, with) of the members of a group that have candidates in another component there.

    ``with`` lists the partners a member is to be checked with; each pair stands at one of its members,
    so there are never more rows than members.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, "key"):
            key, ids = table["key"].to_numpy(), table["id"].to_numpy()
            i, j, _ = _alike(table, num, den, across=True)
            member = np.unique(np.concatenate([i, j]))
            order = np.argsort(i, kind="stable")
            ends = np.searchsorted(i[order], member, "right")
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids[j[order]]))
            yield pa.RecordBatch.from_arrays([pa.array(key[member]), pa.array(ids[member]), lists], ["key", "id", "with"])

    return _by_group(rows, "key").mapInArrow(run, "key bigint, id bigint, with array<bigint>")


def partners(pairs: DataFrame) -> DataFrame:
    """(key, id, with) of pairs (a, b, key), each pair in one of its groups only."""
    once = pairs.groupBy("a", "b").agg(F.min("key").alias("key"))
    first = once.groupBy("key", "a").agg(F.collect_list("b").alias("with")).withColumnRenamed("a", "id")
    return first.unionByName(once.select("key", F.col("b").alias("id"), F.expr("cast(array() as array<bigint>)").alias("with")))


def confirm(needed: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of ``needed`` (key, id, with) whose full sets are similar enough."""
    rows = needed.join(sets, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, "key"):
            here: dict[tuple[int, int], np.ndarray] = {}
            keys, ids, lists, binary = (table[c].to_pylist() for c in ("key", "id", "with", "shingles"))
            for k, i, s in zip(keys, ids, binary):
                here[k, i] = np.frombuffer(s, np.uint64)
            found = []
            for k, i, others in zip(keys, ids, lists):
                x = here[k, i]
                for other in others:
                    y = here[k, other]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if den * both >= num * (len(x) + len(y) - both):
                        found.append((i, other))
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return _by_group(rows, "key").mapInArrow(run, "a bigint, b bigint")


def full_sets(docs: DataFrame, id_col: str, text_col: str, ids: DataFrame) -> DataFrame:
    """id and full set of the texts with these ids; a filter spares the others the shuffle."""
    maybe = among(docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")), "id", ids)
    rows = maybe.filter("__maybe").select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        A.release()
        for batch in batches:
            for part, data, offsets in A.blocks(batch.column("text")):
                sets = pa.array([s.tobytes() for s in shingle_sets(data, offsets)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(part.start, len(sets)), sets], ["id", "shingles"])

    return rows.mapInArrow(run, "id bigint, shingles binary").join(ids, "id", "left_semi").dropDuplicates(["id"])


def _blocked(large: DataFrame) -> DataFrame:
    """Number the members of each large node into blocks of about ``SMALL``."""
    blocks = F.ceil(F.col("size") / SMALL).cast("bigint")
    return large.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id", F.lit(7)), F.col("blocks")))


def _block_pairs(large: DataFrame, comps: DataFrame) -> DataFrame:
    """Both sides of every pair of blocks of a node that can hold members of two components.

    The members outside the node's largest component have blocks of their own, numbered first: each of
    them meets every block, and the largest component's members meet only those. So a node that the
    forest has linked altogether gives no rows.
    """
    labelled = saved(large.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id")), "large")
    sizes = labelled.groupBy("key", "comp").agg(F.count("*").alias("n"))
    most = sizes.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("most"), F.sum("n").alias("all")).filter("most.n < all").select(
        "key", F.col("most.comp").alias("main"), F.ceil((F.col("all") - F.col("most.n")) / SMALL).cast("bigint").alias("outer"),
        F.ceil(F.col("most.n") / SMALL).cast("bigint").alias("inner"))
    rows = labelled.join(saved(most, "most"), "key")
    outside, number = F.col("comp") != F.col("main"), F.xxhash64("id", F.lit(7))
    block = F.when(outside, F.pmod(number, F.col("outer"))).otherwise(F.col("outer") + F.pmod(number, F.col("inner")))
    last = F.when(outside, F.col("outer") + F.col("inner")).otherwise(F.col("outer")) - 1
    rows = rows.select("key", "id", "comp", block.alias("block"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("other"))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    # within one block there is one side (-1), otherwise the lower block is side 0
    side = F.when(F.col("block") == F.col("other"), -1).when(F.col("block") < F.col("other"), 0).otherwise(1)
    return rows.select(F.xxhash64("key", low, high).alias("key"), "id", "comp", side.cast("int").alias("side"))


def _parted(tree: DataFrame, comps: DataFrame) -> DataFrame:
    """The keys of the forest's pairs (a, b, key) whose ends are in two components."""
    for end in ("a", "b"):
        tree = tree.join(comps.select(F.col("id").alias(end), F.col("comp").alias(f"of_{end}")), end, "left")
    return tree.filter(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("key").distinct()


def near_groups(docs: DataFrame, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id and kept of every row; linked if den * shared >= num * all."""
    found = saved(features(docs, id_col, text_col), "features")
    classes = saved(found.filter("n > 0 and id is not null").groupBy("one", "two").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    small, large = nodes(classes, den / num - 1.0)
    groups, some_large = small, not large.isEmpty()
    if some_large:
        # first the blocks of a large node one by one, each with the node's first member, so that it links them
        first = large.groupBy("key").agg(F.min("id").alias("pivot"))
        alone = _blocked(large).select(F.xxhash64("key", "block", "block").alias("key"), "id", F.col("key").alias("node"))
        pivots = alone.select("key", "node").distinct().join(first.withColumnRenamed("key", "node"), "node").select("key", F.col("pivot").alias("id"))
        groups = small.unionByName(alone.select("key", "id")).unionByName(pivots).distinct()
    members = classes.select("id", "n", "sketch")
    rows = groups.join(members, "id").select("key", "id", "n", "sketch", F.col("id").alias("comp"), F.lit(-1).alias("side"))
    tree = saved(forest(rows, num, den), "forest")
    ends = tree.select(F.explode(F.array("a", "b")).alias("id"))
    needed = saved((ends.unionByName(large.select("id")) if some_large else ends).distinct(), "needed")
    sets = saved(full_sets(docs, id_col, text_col, needed), "sets")
    links = saved(confirm(partners(tree), sets, num, den), "links")
    comps = saved(components(links), "comps")
    # what the forest left open: groups that have more candidates and a tree whose ends are in two components;
    # where each tree is within one component, so are all candidates of the group
    open_keys = saved(_parted(tree.filter("more"), comps), "open")
    rest = small.join(open_keys, "key", "left_semi").withColumn("side", F.lit(-1))
    if some_large:
        blocks = saved(_block_pairs(large, comps), "blocks")
        several = saved(blocks.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("key"), "several")
        rest = rest.unionByName(blocks.join(several, "key", "left_semi").select("key", "id", "side"))
    labelled = saved(rest.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id")), "labelled")
    final = comps
    if not labelled.isEmpty():
        rows = labelled.join(members, "id").select("key", "id", "n", "sketch", "comp", "side")
        more = saved(confirm(saved(crossings(rows, num, den), "crossings"), sets, num, den).distinct(), "more")
        final = saved(extended(comps, more), "final")
    named = saved(classes.select("one", "two", "id").join(final, "id", "left").select(
        "one", "two", F.coalesce("comp", "id").alias("component_id")), "named")
    joined = found.select("id", "n", "one", "two").join(named, ["one", "two"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return joined.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                         F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay (the smallest id of each group), with all their columns."""
    gone = near_groups(docs, num, den, id_col, text_col).filter("not kept").select(F.col(id_col).alias("id")).distinct()
    return without(docs, id_col, saved(gone, "gone"))


def of_documents(docs: DataFrame) -> DataFrame:
    """Every document's group at a similarity of 0.85."""
    return near_groups(docs, 85, 100)
