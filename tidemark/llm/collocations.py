"""Phrase collocations by direct-address tiling.

Words get ids by frequency rank; a phrase of k + 1 words is the pair of the phrases of k words that begin
at two neighbouring words, so one counter serves all lengths:

1. Words are counted per language. The ``HEAD`` most frequent words are ranked; their ranks (a table of
   fixed size) are broadcast, with a Bloom filter of at most ``MAX_BITS`` bits of all frequent words.
2. In a task, the pairs of neighbouring ranked items fall into tiles of ``TILE`` x ``TILE`` ranks. A dense
   tile is counted with one ``bincount`` whose index is the address of the pair; sparse tiles are sorted
   coordinates. Pairs with an item beyond the ranks are sorted by 64 bits of their hash, and told apart by
   64 more. Pairs with an item that isn't frequent can't be frequent and are left out.
3. Spark sums the counts by language and phrase. The pairs found often enough are ranked again in the
   place of words, and so on up to ``LONGEST`` words.

Nothing depends on hashes but which phrases are counted in vain: a filter that is too small for the corpus
lets rare phrases through, and Spark drops them by their counts.

A phrase's score is that of its weakest cut in two parts, floor(``SCALE`` * a / (l + r)) with the counts a
of the phrase, l and r of the parts. Phrases inside a longer one that accounts for ``COVERED`` percent of
them or more are dropped. All counts and comparisons are exact.

Defined results: null texts are empty; a null language is ``und``; a text without words adds nothing; ties
in score and count go to the phrase first in byte order; repeated rows count each time; ids aren't read;
other columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm import arrays as A
from tidemark.llm.bloom import BUCKET, bitmaps, bits_of, bucket_of
from tidemark.llm.storage import parallelism, saved

LEAST, LONGEST, SCALE, COVERED, TOP = 30, 4, 2_000_000, 80, 2000
HEAD = 1 << 16
TILE_BITS = 10
TILE = 1 << TILE_BITS
DENSE = TILE * TILE // 32
MAX_BITS = 1 << 28
BLOCK = 1 << 21
UNKNOWN = "und"
COUNTS = "lang string, phrase string, a bigint"
_SEPARATES = np.zeros(256, bool)
_SEPARATES[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_APART = _SEPARATES.copy()
_APART[[0x20, 0x09]] = True


class Text:
    """Words of a block of lower-cased texts: spans, the piece and the language of each, and two hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: pa.Array):
        self.data, self.langs = A.LOWER[data], langs
        words = A.words(self.data, offsets, _APART)
        self.starts, self.ends = words.starts, words.ends
        self.doc = A.owner(words.first)
        # both numbers only grow, so their sum changes wherever a piece or a text ends
        self.piece = np.searchsorted(np.flatnonzero(_SEPARATES[self.data]), self.starts) + self.doc
        own = A.mix(A.span_hashes(self.data, self.starts, self.ends) ^ _language_hashes(langs)[self.doc])
        self.one, self.two = own, A.mix(own * A.U(0x9FB21C651E98DF25) + _second(self.data, self.starts, self.ends))

    def phrases(self, first: np.ndarray, n: int) -> pa.Array:
        words = [A.strings(self.data, self.starts[first + k], self.ends[first + k]) for k in range(n)]
        return pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())) if n > 1 else words[0]

    def rows(self, first: np.ndarray, n: int, counts: np.ndarray) -> pa.RecordBatch:
        """(lang, phrase, a) of the phrases of n words that begin at the words ``first``."""
        return pa.RecordBatch.from_arrays(
            [self.langs.take(pa.array(self.doc[first])), self.phrases(first, n).cast(pa.string()), pa.array(counts.astype(np.int64))], ["lang", "phrase", "a"])


def _language_hashes(langs: pa.Array) -> np.ndarray:
    data, offsets = A.buffers(langs)
    return A.mix(A.span_hashes(data, offsets[:-1], offsets[1:]) + A.U(0x632BE59BD9B4E019))


def _second(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span that doesn't depend on the first one: of its length, its first and its last 8 bytes."""
    size = (ends - starts).astype(A.U)
    padded = np.concatenate([np.zeros(8, np.uint8), data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), np.dtype("<u8"), padded, strides=(1,))
    unused = A.U(64) - A.U(8) * np.minimum(size, A.U(8))
    head, tail = eight[starts + 8] << unused, eight[ends] >> unused
    return A.mix(head * A.U(0xC2B2AE3D27D4EB4F) + A.mix(tail + size * A.U(0xA24BAED4963EE407)))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[Text]:
    for batch in batches:
        for part, data, offsets in A.blocks(batch.column("text"), BLOCK):
            yield Text(data, offsets, batch.column("lang").slice(part.start, len(offsets) - 1))


def _runs(order_by: np.ndarray, check: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index of one occurrence of each distinct value, and how many there are; ``check`` tells equal values apart."""
    order = np.argsort(order_by, kind="stable")
    ordered = order_by[order]
    heads = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    if check is not None:
        second = check[order]
        if ((second[1:] != second[:-1]) & ~heads[1:]).any():
            order = np.lexsort((check, order_by))
            ordered, second = order_by[order], check[order]
            heads[1:] = (ordered[1:] != ordered[:-1]) | (second[1:] != second[:-1])
    at = np.flatnonzero(heads)
    return order[at], np.diff(np.append(at, len(order)))


class Frequent:
    """What a task knows of the frequent phrases of one length: ranks of the first, a filter of all."""

    def __init__(self, one: np.ndarray, two: np.ndarray, bits: np.ndarray):
        order = np.argsort(one)
        self.one, self.two, self.rank, self.bits = one[order], two[order], order.astype(np.int64), bits

    def look(self, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each item (-1 beyond the ranks), and whether it may be frequent."""
        at = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
        rank = np.where((self.one[at] == one) & (self.two[at] == two), self.rank[at], -1)
        maybe = rank >= 0
        rest = np.flatnonzero(~maybe)
        key = one[rest]
        bucket = (key >> A.U(32)) % A.U(len(self.bits) * 8 // BUCKET)
        good = np.ones(len(rest), bool)
        for k in range(2):
            bit = bucket * A.U(BUCKET) + ((key >> A.U(15 * k)) & A.U(BUCKET - 1))
            good &= (self.bits[(bit >> A.U(3)).astype(np.int64)] >> (bit & A.U(7)).astype(np.uint8)) & 1 == 1
        maybe[rest[good]] = True
        return rank, maybe


def count_pairs(left: np.ndarray, right: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of items: index of one occurrence of each, and counts.

    ``left`` and ``right`` are ranks, -1 for items without one; the pairs of those go by their hashes.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    side = HEAD >> TILE_BITS
    ranked = np.flatnonzero((left >= 0) & (right >= 0))
    tile = (left[ranked] >> TILE_BITS) * side + (right[ranked] >> TILE_BITS)
    sizes = np.bincount(tile, minlength=side * side)
    for t in np.flatnonzero(sizes >= DENSE):
        here = ranked[tile == t]
        cell = ((left[here] & (TILE - 1)) << TILE_BITS) | (right[here] & (TILE - 1))
        counts, sample = np.bincount(cell, minlength=TILE * TILE), np.empty(TILE * TILE, np.int64)
        sample[cell] = here
        full = np.flatnonzero(counts)
        found.append((sample[full], counts[full]))
    sparse = ranked[sizes[tile] < DENSE]
    if len(sparse):
        at, counts = _runs(left[sparse] * HEAD + right[sparse])
        found.append((sparse[at], counts))
    rest = np.flatnonzero((left < 0) | (right < 0))
    if len(rest):
        at, counts = _runs(one[rest], two[rest])
        found.append((rest[at], counts))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _source(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))


def count_words(source: DataFrame) -> DataFrame:
    """(lang, phrase, a) of every word, and with a null phrase the number of words of the language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text in _texts(batches):
            if len(text.one):
                yield text.rows(*_with_n(_runs(text.one, text.two), 1))
                total = np.bincount(text.doc, minlength=len(text.langs))
                yield pa.RecordBatch.from_arrays([text.langs, pa.nulls(len(total), pa.string()), pa.array(total)], ["lang", "phrase", "a"])

    return source.mapInArrow(run, COUNTS).groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def _with_n(found: tuple[np.ndarray, np.ndarray], n: int) -> tuple[np.ndarray, int, np.ndarray]:
    return found[0], n, found[1]


def count_longer(source: DataFrame, frequent, n: int) -> DataFrame:
    """(lang, phrase, a) of the phrases of n words whose parts of n - 1 words may all be frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text in _texts(batches):
            total = len(text.one) - n + 1
            if total <= 0:
                continue
            rank, maybe = frequent.value.look(A.rolling(text.one, n - 1), A.rolling(text.two, n - 1))
            at = np.flatnonzero(maybe[:-1] & maybe[1:] & (text.piece[:total] == text.piece[n - 1:]))
            first, counts = count_pairs(rank[at], rank[at + 1], A.rolling(text.one, n)[at], A.rolling(text.two, n)[at])
            if len(first):
                yield text.rows(at[first], n, counts)

    return source.mapInArrow(run, COUNTS).groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def _hashes(lang: pa.Array, phrase: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes that the phrases of n words have in their texts; each is a text of its own here."""
    data, offsets = A.buffers(phrase)
    text = Text(data, offsets, lang)
    first = np.arange(len(phrase)) * n
    return A.rolling(text.one, n)[first], A.rolling(text.two, n)[first]


def ranked(counts: DataFrame, n: int):
    """Broadcast ``Frequent`` of the phrases of n words in ``counts`` (saved); its size is bounded."""
    spark = counts.sparkSession
    head = counts.orderBy(F.desc("a"), "lang", "phrase").limit(HEAD).select("lang", "phrase").toArrow().combine_chunks()
    one, two = _hashes(head["lang"].combine_chunks(), head["phrase"].combine_chunks(), n)
    buckets = max(1, min(16 * counts.count(), MAX_BITS) // BUCKET)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(_hashes(batch.column("lang"), batch.column("phrase"), n)[0].astype(np.int64))], ["key"])

    slots = counts.select("lang", "phrase").mapInArrow(keys, "key bigint").select(
        bucket_of("key", buckets).alias("bucket"), F.explode(F.array(*bits_of("key"))).alias("bit"))
    bits = np.zeros((buckets, BUCKET // 8), np.uint8)
    for bucket, bitmap in bitmaps(slots).toLocalIterator():
        bits[bucket] = np.frombuffer(bitmap, np.uint8)
    return spark.sparkContext.broadcast(Frequent(one, two, bits.reshape(-1)))


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                  longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, a) of the phrases of 1 to ``longest`` words with ``a >= least``; and (lang, n)."""
    source = _source(docs, text_col, lang_col)
    words = saved(count_words(source).filter(F.col("phrase").isNull() | (F.col("a") >= least)), "words")
    totals = words.filter("phrase is null and a > 0").select("lang", F.col("a").alias("n"))
    level = words.filter("phrase is not null")
    found = level.select("lang", F.lit(1).alias("k"), "phrase", "a")
    for n in range(2, longest + 1):
        if level.isEmpty():
            break
        level = saved(count_longer(source, ranked(level, n - 1), n).filter(F.col("a") >= least), f"phrases{n}")
        found = found.unionByName(level.select("lang", F.lit(n).alias("k"), "phrase", "a"))
    return found, totals


def _part(first: Column, size: Column) -> Column:
    return F.array_join(F.slice("w", first, size), " ")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, k, phrase, a, l, r, score) of the phrases of two words or more, by their weakest cut."""
    at = F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    cuts = counts.filter("k > 1").select("*", F.split("phrase", " ").alias("w")).select("*", at).select(
        "lang", "k", "phrase", "a", "cut", _part(F.lit(1), F.col("cut")).alias("first"), _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    both = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    wide = "decimal(28,0)"
    score = F.expr(f"cast({SCALE} * cast(a as {wide}) div (cast(l as {wide}) + cast(r as {wide})) as bigint)")
    weakest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("x")
    return both.groupBy("lang", "k", "phrase", "a").agg(weakest).select("lang", "k", "phrase", "a", "x.l", "x.r", "x.score")


def covered(counts: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the largest count of a longer phrase that holds this phrase of two words or more."""
    size = F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size")
    at = F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at")
    inner = counts.filter("k > 2").select("lang", "k", "a", F.split("phrase", " ").alias("w")).select("*", size).select("*", at)
    return inner.select("lang", _part(F.col("at"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                 longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first ``top`` phrases."""
    counts, totals = phrase_counts(docs, text_col, lang_col, least, longest)
    longer = saved(covered(counts), "covered")
    kept = saved(scored(counts), "scored").join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(28,0)") * 100 < F.col("a").cast("decimal(28,0)") * COVERED))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # each part of a language keeps its first rows, so no task orders all phrases of one language
    part = F.pmod(F.xxhash64("phrase"), F.lit(parallelism(docs.sparkSession))).alias("part")
    near = kept.select("*", part).withColumn("at", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("at") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    first = near.withColumn("rank", rank).filter(F.col("rank") <= top)
    return first.join(F.broadcast(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def of_documents(docs: DataFrame) -> DataFrame:
    """Each language's first 2000 phrases of two to four words."""
    return collocations(docs)


ORACLE = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
     p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
     w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
     s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
     g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM s, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(ws)),
     f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
     n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
     c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
     x AS (SELECT c.lang, c.k, c.phrase, c.a, c.cut, l.a AS l, r.a AS r, (2000000 * c.a::HUGEINT // (l.a + r.a))::BIGINT AS score
           FROM c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:c.cut], ' ')
                  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.cut + 1:], ' ')),
     y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
     i AS (SELECT lang, k, a, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS i FROM f WHERE k > 2),
     j AS (SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM i, (SELECT unnest([2, 3]) AS m) WHERE m < k AND i + m - 1 <= k),
     h AS (SELECT lang, phrase, max(a) AS longer FROM j GROUP BY ALL)
SELECT y.lang, row_number() OVER (PARTITION BY y.lang ORDER BY score DESC, y.a DESC, y.phrase) AS rank, y.phrase, y.a, l, r, n.n, score
FROM y JOIN n USING (lang) LEFT JOIN h ON h.lang = y.lang AND h.phrase = y.phrase
WHERE longer IS NULL OR 100 * longer < 80 * y.a
QUALIFY rank <= 2000"""
