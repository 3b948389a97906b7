"""Toxicity by a classifier chain.

The categories (columns of the label table) are predicted in order, each by a linear model over hashed
n-grams of bytes; a later model also gets the earlier categories' probabilities. While it is trained,
those come from models that have not seen the row (out-of-fold predictions), so it learns from inputs as
they will be at prediction.

Training: about ``TRAIN_ROWS`` labelled rows are drawn by a hash of the id. Their n-grams' document
frequencies are summed per category in Spark; the ``FEATURES`` n-grams of highest G-statistic per
category are kept, and the models are fitted on these few features of the drawn rows. Presence counts,
not frequency, so a long text is no more suspect than a short one. Prediction covers every whole text.

Defined results: null and empty texts have no features and get the models' base rates; rows without a
label or with a null one are not learned from; repeated labels of an id count as their maximum; without
usable labels every probability is 0; columns other than id and text are not looked at; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import arrays as A

CATEGORIES = ("quality", "toxic")  # in the order of the chain
BITS = 18
ORDERS = (3, 5)
TRAIN_ROWS = 20_000
FEATURES = 3_000
MIN_GAIN = 15.0  # half the G-statistic; chance alone exceeds it about once in 20 million n-grams
MIN_ROWS = 8
FOLDS = 3
LIMIT = 0.4
STRETCH = 1 << 18  # (row, column) pairs taken at once: about fifty bytes of memory for each
BLANK = A.LOWER.copy()
BLANK[A.SPACE] = 32


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text number) of every n-gram of lower-cased bytes, white space being a blank."""
    values = BLANK[data].astype(np.uint64)
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    for n in ORDERS:
        if len(values) >= n:
            inside = doc[:len(values) - n + 1] == doc[n - 1:]
            bucket = (A.rolling(values, n) >> np.uint64(64 - BITS)).astype(np.int32)
            yield bucket[inside], doc[:len(inside)][inside]


def _present(bucket: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (bucket, text) pairs."""
    pairs = np.unique(doc.astype(np.int64) << BITS | bucket)
    return (pairs & ((1 << BITS) - 1)).astype(np.int32), (pairs >> BITS).astype(np.int32)


def _tally(index: np.ndarray, weight: Callable[[slice], np.ndarray], size: int) -> np.ndarray:
    """``bincount`` of the index, a stretch at a time; the sums carry on, so they are the same to the last bit."""
    total = np.zeros(size)
    for first in range(0, len(index), STRETCH):
        part = slice(first, first + STRETCH)
        total = np.bincount(np.concatenate([np.arange(size, dtype=index.dtype), index[part]]), weights=np.concatenate([total, weight(part)]))
    return total


@dataclass
class Linear:
    weights: np.ndarray
    bias: float

    def probability(self, rows: np.ndarray, cols: np.ndarray, extra: np.ndarray, n: int) -> np.ndarray:
        """Features as (row, column) pairs; ``extra`` holds the earlier categories' log odds."""
        k = extra.shape[1]
        weights = self.weights[k:]
        x = _tally(rows, lambda part: weights[cols[part]], n) + extra @ self.weights[:k] + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(rows, cols, extra, y, width: int, steps: int = 60, ridge: float = 5e-5, memory: int = 8) -> Linear:
    """Logistic regression with a small ridge, by limited-memory BFGS."""
    n, k = max(len(y), 1), extra.shape[1]

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        p = Linear(w[:-1], w[-1]).probability(rows, cols, extra, len(y))
        error = (p - y) / n
        slope = np.concatenate([extra.T @ error, _tally(cols, lambda part: error[rows[part]], width), [error.sum()]])
        slope[:-1] += ridge * w[:-1]
        safe = np.clip(np.where(y > 0, p, 1 - p), 1e-13, 1)
        return -np.log(safe).sum() / n + ridge / 2 * float(w[:-1] @ w[:-1]), slope

    w = np.zeros(width + k + 1)
    prior = np.clip(y.mean() if len(y) else 0.0, 1e-4, 1 - 1e-4)
    w[-1] = np.log(prior / (1 - prior))
    value, slope = loss(w)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        way, kept = slope.copy(), []
        for s, d, curve in reversed(past):
            kept.append(curve * (s @ way))
            way -= kept[-1] * d
        if past:
            way *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1])
        for (s, d, curve), a in zip(past, reversed(kept)):
            way += (a - curve * (d @ way)) * s
        step, down = 1.0 if past else min(1.0, 1.0 / (np.abs(slope).sum() + 1e-12)), float(slope @ way)
        for _ in range(20):
            new, new_slope = loss(w - step * way)
            if new <= value - 1e-4 * step * down:
                break
            step /= 2
        else:
            break
        s, d = -step * way, new_slope - slope
        if s @ d > 1e-14:
            past = [*past, (s, d, 1.0 / float(s @ d))][-memory:]
        w, slope, gained = w + s, new_slope, value - new
        value = new
        if gained < 1e-7:
            break
    return Linear(w[:-1], float(w[-1]))


def _odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p)) / 4.0


class Chain:
    """The fitted models in order, and the column of every kept bucket (-1: not kept)."""

    def __init__(self, column_of: np.ndarray, models: list[Linear]):
        self.column_of, self.models = column_of, models

    def predict(self, rows: np.ndarray, cols: np.ndarray, n: int) -> list[np.ndarray]:
        found: list[np.ndarray] = []
        for model in self.models:
            extra = np.stack([_odds(p) for p in found], axis=1) if found else np.zeros((n, 0))
            found.append(model.probability(rows, cols, extra, n))
        return found


def fit_chain(column_of: np.ndarray, width: int, rows: np.ndarray, cols: np.ndarray, labels: np.ndarray, fold: np.ndarray) -> Chain:
    """Fit each category's model; the next ones see what models of the other folds say of a row."""
    n, models, outside = len(labels), [], []
    for c in range(labels.shape[1]):
        y = labels[:, c].astype(float)
        extra = np.stack(outside, axis=1) if outside else np.zeros((n, 0))
        models.append(fit_linear(rows, cols, extra, y, width))
        guess = np.zeros(n)
        for f in range(FOLDS) if c + 1 < labels.shape[1] else ():
            learn = fold != f
            number = (np.cumsum(learn) - 1).astype(rows.dtype)
            mine = learn[rows]
            part = fit_linear(number[rows[mine]], cols[mine], extra[learn], y[learn], width)
            guess[~learn] = part.probability(rows, cols, extra, n)[~learn]
        outside.append(_odds(guess))
    return Chain(column_of, models)


def _source(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), *more)


def fit(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES, id_col: str = "doc_id",
        text_col: str = "text") -> Chain:
    """Fit the chain on a bounded sample of the labelled rows of ``docs``."""
    named = [f"__y{k}" for k in range(len(categories))]
    known = labels.select(F.col(f"`{id_col}`").alias("__id"), *[F.col(f"`{c}`").cast("int").alias(n) for c, n in zip(categories, named)])
    known = known.dropna().groupBy("__id").agg(*[F.max(n).alias(n) for n in named])
    share = min(1.0, TRAIN_ROWS / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64("__id", F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20)))
    # about TRAIN_ROWS narrow rows, so the broadcast is bounded
    sample = docs.join(F.broadcast(drawn), F.col(f"`{id_col}`") == F.col("__id"))
    sample = _source(sample, id_col, text_col, *named)
    size = 1 << BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        A.release()
        tally = np.zeros((1 + len(named), size), np.int64)
        for batch in batches:
            labels = np.stack([batch.column(n).to_numpy() for n in named])
            for part, data, offsets in A.blocks(batch.column("text")):
                for bucket, doc in features(data, offsets):
                    bucket, doc = _present(bucket, doc)
                    tally[0] += np.bincount(bucket, minlength=size)
                    for k, y in enumerate(labels[:, part]):
                        tally[1 + k] += np.bincount(bucket[y[doc] == 1], minlength=size)
        at = np.flatnonzero(tally[0])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *[pa.array(t[at]) for t in tally]], ["bucket", "n", *named])

    tallies = sample.mapInArrow(count, "bucket int, n bigint, " + ", ".join(f"{n} bigint" for n in named))
    sums = tallies.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ["n", *named]]).filter(F.col("n") >= MIN_ROWS)
    totals = drawn.agg(F.count("*").alias("n"), *[F.sum(n).alias(n) for n in named]).first()
    chosen: set[int] = set()
    for name in named:
        with_label, rows = float(totals[name] or 0), float(totals["n"])
        a, row = F.col(name).cast("double"), F.col("n").cast("double")
        cells = [(a, row * (with_label / max(rows, 1.0))), (row - a, row * (1 - with_label / max(rows, 1.0)))]
        gain = sum((F.when(seen > 0, seen * F.log(seen / F.greatest(expected, F.lit(1e-9)))).otherwise(0.0) for seen, expected in cells), F.lit(0.0))
        chosen |= {r["bucket"] for r in sums.select("bucket", gain.alias("gain")).filter(F.col("gain") >= MIN_GAIN).orderBy(F.desc("gain"), "bucket").limit(FEATURES).collect()}
    column_of = np.full(size, -1, np.int32)
    column_of[sorted(chosen)] = np.arange(len(chosen))

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in A.blocks(batch.column("text")):
                rows, cols = kept_features(data, offsets, column_of)
                ends = np.searchsorted(rows, np.arange(len(offsets)))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cols, pa.int32()))
                more = [batch.column(c).slice(part.start, part.stop - part.start) for c in ["id", *named]]
                yield pa.RecordBatch.from_arrays([*more, lists], ["id", *named, "cols"])

    kind = docs.schema[id_col].dataType.simpleString()
    table = sample.mapInArrow(narrow, f"id {kind}, " + ", ".join(f"{n} int" for n in named) + ", cols array<int>")
    table = table.withColumn("fold", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(FOLDS))).orderBy("id").toArrow()
    y = np.stack([table[n].to_numpy() for n in named], axis=1) if table.num_rows else np.zeros((0, len(named)))
    if table.num_rows == 0:
        return Chain(column_of, [Linear(np.zeros(len(chosen) + k), -30.0) for k in range(len(named))])
    fold, lists = table["fold"].to_numpy(), table["cols"]
    sizes = pc.list_value_length(lists).to_numpy().astype(int)
    rows = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    cols = np.concatenate([chunk.flatten().to_numpy() for chunk in lists.chunks])
    del table, lists  # the driver holds the pairs once
    A.release()
    chain = fit_chain(column_of, len(chosen), rows, cols, y, fold)
    del rows, cols
    A.release()
    return chain


def kept_features(data: np.ndarray, offsets: np.ndarray, column_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, column) pairs, in order."""
    rows, cols = [], []
    for bucket, doc in features(data, offsets):
        column = column_of[bucket]
        hit = column >= 0
        rows.append(doc[hit])
        cols.append(column[hit])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.concatenate(rows).astype(np.int64) << 32 | np.concatenate(cols))
    return pairs >> 32, pairs & 0xFFFFFFFF


def score(docs: DataFrame, chain: Chain, categories: tuple[str, ...] = CATEGORIES, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``p_<category>`` of every row (columns of those names are replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    outs = [f"p_{c}" for c in categories]
    kept = [c for c in docs.columns if c not in outs]
    source = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = source.select(*[F.col(f"`{c}`") for c in kept], *[F.lit(0.0).alias(o) for o in outs]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        A.release()
        for batch in batches:
            for part, data, offsets in A.blocks(batch.column(text_col)):
                rows, cols = kept_features(data, offsets, shared.value.column_of)
                found = shared.value.predict(rows, cols, len(offsets) - 1)
                here = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([*here.columns, *[pa.array(p) for p in found]], [*kept, *outs])

    return source.mapInArrow(run, schema)


def of_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's probabilities and whether it is rejected as toxic."""
    found = score(docs.select("doc_id", "text"), fit(docs, labels))
    return found.select("doc_id", "p_quality", "p_toxic", (F.col("p_toxic") >= LIMIT).alias("rejected"))


def drop_toxic(docs: DataFrame, labels: DataFrame, limit: float = LIMIT) -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    found = score(docs, fit(docs, labels))
    return found.filter(F.col("p_toxic") < limit).select(*[F.col(f"`{c}`") for c in docs.columns])
