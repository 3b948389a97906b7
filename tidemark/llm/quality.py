"""Quality rules by repetition coverage: the share of a text that lies inside repeated n-grams and lines.

Rolling hashes of the words give every n-gram of the lengths in ``Limits.grams``; an n-gram that occurs
again in the same text marks all its words, and the characters of the marked words are measured. Lines
are measured the same way. Everything is one pass over whole texts without a shuffle.

The limits of 5 to 10 words and of lines are those published for MassiveText (Rae et al. 2021, table A1:
characters in duplicate n-grams, each counted once, and in duplicate lines). For 3 words only the share of
the most common one is published, which is counted otherwise; that limit stays close to the base rule.

Defined results: null and empty texts have no words and fail the base rules; equal rows get equal
results; other input columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import arrays as A

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    """A text is kept if it passes the base rules and stays within every share."""
    min_words: int = 50
    base_repeat_share: float = 0.5
    line_share: float = 0.20
    symbols_per_word: float = 0.10
    # characters inside repeated n-grams, over all characters of words
    grams: dict[int, float] = field(default_factory=lambda: {3: 0.45, 5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10})


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measure(data: np.ndarray, offsets: np.ndarray, limits: Limits) -> dict[str, np.ndarray]:
    """The counts of each text of a block, its shares, and both verdicts."""
    points = np.concatenate([[0], np.cumsum(A.code_points(data))])
    w = A.words(data, offsets)
    total, doc = len(w.starts), A.owner(w.first)
    hashes = A.span_hashes(data, w.starts, w.ends)
    chars = points[w.ends] - points[w.starts]
    out = {"n_words": w.counts, "word_chars": A.sums(chars, w.first), "n_symbols": A.sums(SYMBOLS[data], offsets)}
    whole = np.maximum(out["word_chars"], 1)

    def covered(n: int) -> np.ndarray:
        """Flags of the words inside an n-gram found twice or more in their text."""
        starts = np.flatnonzero(A.within(w.first, n, total))
        again, _ = A.repeats(A.rolling(hashes, n)[starts], doc[starts])
        edge = np.zeros(total + n + 1, np.int32)
        edge[starts[again]] += 1
        edge[starts[again] + n] -= 1
        return np.cumsum(edge)[:total] > 0

    # lines: spans between line feeds, cut at the ends of texts; only lines with a word count
    feed = data == 10
    starts = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(feed) + 1]))
    starts = starts[starts < len(data)]
    line_doc = np.searchsorted(offsets, starts, "right") - 1
    feeds = np.append(np.flatnonzero(feed), len(data))
    ends = np.minimum(feeds[np.searchsorted(feeds, starts)], offsets[line_doc + 1])
    has_word = np.searchsorted(w.starts, starts) < np.searchsorted(w.starts, ends)
    starts, ends, line_doc = starts[has_word], ends[has_word], line_doc[has_word]
    _, before = A.repeats(A.span_hashes(data, starts, ends), line_doc)
    line_first = np.searchsorted(starts, offsets)
    out["n_dup_lines"] = A.sums(before, line_first)
    upto = np.concatenate([[0], np.cumsum(chars)])
    line_chars = upto[np.searchsorted(w.starts, ends)] - upto[np.searchsorted(w.starts, starts)]
    share = {"line_share": A.sums(np.where(before, line_chars, 0), line_first) / whole}
    marked = covered(3)
    out["n_repeat_words"] = A.sums(marked, w.first)
    for n in limits.grams:
        inside = marked if n == 3 else covered(n)
        share[f"gram{n}_share"] = A.sums(np.where(inside, chars, 0), w.first) / whole
    out["base_failed"] = (out["n_words"] < limits.min_words) | (
        out["n_repeat_words"] > limits.base_repeat_share * out["n_words"])
    kept = ~out["base_failed"] & (share["line_share"] <= limits.line_share)
    kept &= out["n_symbols"] <= limits.symbols_per_word * out["n_words"]
    for n, most in limits.grams.items():
        kept &= share[f"gram{n}_share"] <= most
    return out | share | {"kept": kept}


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  limits: Limits = Limits()) -> DataFrame:
    """id, counts, shares, base_failed and kept of every row."""
    shares = ["line_share", *[f"gram{n}_share" for n in limits.grams]]
    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, " + ", ".join(
        [f"{c} bigint" for c in COUNTS] + [f"{c} double" for c in shares]) + ", base_failed boolean, kept boolean"
    names = [*COUNTS, *shares, "base_failed", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in A.blocks(batch.column("text")):
                found = measure(data, offsets, limits)
                ids = batch.column("id").slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(found[c]) for c in names]], ["id", *names])

    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def of_documents(docs: DataFrame) -> DataFrame:
    """Every document's counts and verdict."""
    found = quality_rules(docs)
    return found.select("doc_id", *COUNTS, "base_failed", "kept")
