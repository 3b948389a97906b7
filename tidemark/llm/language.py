"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the hashed n-grams of labelled texts per language, as map-side combined sums; the log
probabilities form a matrix of ``BUCKETS`` x languages (its size does not depend on the data), which is
broadcast. Scoring looks up each n-gram's row and sums the rows of a text in numpy, without a shuffle.
The classifier is fitted on a sample of about ``TRAIN_ROWS`` labelled rows, drawn by a hash of the id.

Defined results: null texts and texts without a letter are ``und`` with score 0, and so are all texts if
there is nothing to learn from; ties go to the language first in order; a null id counts as an empty
one; other columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.arrays import U, mix

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
TRAIN_ROWS = 20_000
BLOCK = 1 << 18
UNKNOWN = "und"
_STEP = U(0x9E3779B97F4A7C15 | 1)


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``BLOCK`` characters in lower case."""
    first, held, size = 0, [], 0
    for at, text in enumerate(texts):
        held.append((text or "").lower())
        size += len(held[-1])
        if size >= BLOCK:
            yield first, held
            first, held, size = at + 1, [], 0
    if held:
        yield first, held


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, the text each belongs to, and whether the texts have a letter.

    What is no letter counts as a blank; n-grams neither begin nor end between two texts and hold a
    letter at one of their ends.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    points = np.where(letter, points, 32).astype(U)
    doc = np.repeat(np.arange(len(texts)), sizes)
    found, owners = [], []
    for n in ORDERS:
        count = len(points) - n + 1
        if count <= 0:
            continue
        h = points[:count].copy()
        for k in range(1, n):
            h = h * _STEP + points[k:count + k]
        good = (letter[:count] | letter[n - 1:]) & (doc[:count] == doc[n - 1:])
        found.append((mix(h[good] + U(n)) & U(BUCKETS - 1)).astype(np.int64))
        owners.append(doc[:count][good])
    has_letter = np.bincount(doc[letter], minlength=len(texts)) > 0
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has_letter
    return np.concatenate(found), np.concatenate(owners), has_letter


def count_ngrams(labelled: DataFrame) -> DataFrame:
    """(lang, bucket, n) of a frame (lang, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, texts in _blocks(batch.column("text").to_pylist()):
                bucket, owner, _ = ngrams(texts)
                names = langs[first:first + len(texts)]
                for lang in set(names):
                    mine = np.array([name == lang for name in names])
                    counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    counts[lang] += np.bincount(bucket[mine[owner]], minlength=BUCKETS)
        for lang, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(n[at])], ["lang", "bucket", "n"])

    partial = labelled.mapInArrow(run, "lang string, bucket int, n bigint")
    return partial.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Languages in order, and the log probability of every bucket in each of them."""

    def __init__(self, counts: pa.Table):
        names = sorted(set(counts["lang"].to_pylist()))
        table = np.zeros((BUCKETS, len(names)))
        at = {name: k for k, name in enumerate(names)}
        column = np.array([at[name] for name in counts["lang"].to_pylist()], np.int64)
        table[counts["bucket"].to_numpy(), column] = counts["n"].to_numpy()
        table += 0.5
        self.names, self.logs = names, np.log(table / table.sum(axis=0)).astype(np.float32)

    def score(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Best language and its posterior probability (languages being equally likely before)."""
        bucket, owner, has_letter = ngrams(texts)
        totals = np.zeros((len(texts), len(self.names)))
        for k in range(len(self.names)):
            totals[:, k] = np.bincount(owner, weights=self.logs[bucket, k], minlength=len(texts))
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best = totals.argmax(axis=1)
        odds = np.exp(totals - totals.max(axis=1, keepdims=True))
        score = np.where(has_letter, 1.0 / odds.sum(axis=1), 0.0)
        return [self.names[b] if ok else UNKNOWN for b, ok in zip(best, has_letter)], score


def fit(labelled: DataFrame) -> Model:
    """Model of a frame (lang, text); what reaches the driver is at most BUCKETS rows a language."""
    return Model(count_ngrams(labelled).toArrow())


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _blocks(batch.column("text").to_pylist()):
                names, score = shared.value.score(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(first, len(texts)), pa.array(names, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    return source.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def of_documents(docs: DataFrame) -> DataFrame:
    """Every document's language, learned from the documents that are not held out."""
    known = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = min(1.0, TRAIN_ROWS / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)))
    model = fit(drawn.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
