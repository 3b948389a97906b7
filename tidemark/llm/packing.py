"""Best-two-fit packing of tokenised documents into sequences of bounded length.

A bin is filled greedily with the largest piece that fits. If a gap is left, its smallest piece is
taken out again whenever two unpacked pieces fill the larger gap more tightly. Pieces are dealt evenly
over shards of about ``SHARD`` pieces, each packed by one task; bins that stay less than ``FULL`` full
are opened again and their pieces packed together in a second round, so that shards cost nearly nothing.

Defined results: null and empty texts are the end token alone; repeated rows are packed as documents of
their own; only the id and text columns are looked at; an empty table gives an empty table.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Encoding, Tokenizer

from tidemark.llm import arrays as A
from tidemark.llm.storage import saved

SHARD = 16_384
FULL = 0.97
MAX_WORDS = 400_000
LONGEST_KEPT = 64
TOGETHER = 256
ROWS, TEXT = 2048, 1 << 21  # rows and bytes whose words are looked up at once
OUT = 256  # rows whose ids are given out at once
SPECIAL, MARKS = b"<|", b".,;:!?"


class Lately:
    """Packed ids of the keys met lately, in two generations of about ``MAX_WORDS``."""

    def __init__(self):
        self.newer, self.older = {}, {}

    def find(self, keys: list[bytes]) -> tuple[list[bytes | None], list[int]]:
        """Packed ids of each key, and the numbers of the keys not met."""
        found = list(map(self.newer.get, keys))
        missing = [i for i, packed in enumerate(found) if packed is None]
        if missing and self.older:
            for i in missing:
                found[i] = self.older.get(keys[i])
            self.add({keys[i]: found[i] for i in missing if found[i] is not None})
            missing = [i for i in missing if found[i] is None]
        return found, missing

    def add(self, made: dict[bytes, bytes]) -> None:
        if len(self.newer) >= MAX_WORDS:
            self.newer, self.older = {}, self.newer
        self.newer |= made


class WordIds:
    """Packed ids (uint32, little-endian) of words; words and their parts met lately are kept, in one table.

    A new word's upper case and end marks are taken off first, as the parts so left are fewer: the
    tokenizer lower-cases, and splits between a letter and a mark. New parts are encoded ``TOGETHER`` at a
    time, as one text with a blank between two of them.
    """

    def __init__(self, path: str):
        self.tokenizer, self.known = Tokenizer.from_file(path), Lately()

    def of(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word; the words are distinct."""
        found, new = self.known.find(words)
        split = [self._split(words[i]) for i in new]
        ids = self._parts(list({part for parts in split for part in parts}))
        made = {}
        for i, parts in zip(new, split):
            packed = found[i] = ids[parts[0]] if len(parts) == 1 else ids[parts[0]] + ids[parts[1]]
            if parts[0] is not words[i] and len(words[i]) <= LONGEST_KEPT:  # a word that is its own part is kept already
                made[words[i]] = packed
        self.known.add(made)
        return found

    def _parts(self, parts: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids of distinct parts."""
        found, new = self.known.find(parts)
        ids, rest = dict(zip(parts, found)), []
        for part in [parts[i] for i in new]:
            if len(part) > LONGEST_KEPT or SPECIAL in part:
                ids[part] = array("I", self._encode(part.decode()).ids).tobytes()
            else:
                rest.append(part)
        made = self._together(rest)
        self.known.add(made)
        return ids | made

    def _split(self, word: bytes) -> tuple[bytes, ...]:
        """The parts that the tokenizer treats separately; special tokens and long words stay whole."""
        if len(word) > LONGEST_KEPT or SPECIAL in word:
            return (word,)
        lower = word.lower()
        core = lower.rstrip(MARKS)
        if core and core != lower and (core[-1:].isalpha() or core[-1] > 127 and core.decode()[-1].lower()[-1].isalpha()):
            return core, lower[len(core):]
        return (word,) if lower == word else (lower,)

    def _encode(self, text: str) -> Encoding:
        return self.tokenizer.encode(text, add_special_tokens=False)

    def _together(self, parts: list[bytes]) -> dict[bytes, bytes]:
        ids = {}
        for first in range(0, len(parts), TOGETHER):
            some = parts[first:first + TOGETHER]
            texts = [part.decode() for part in some]
            found = self._encode(" ".join(texts))
            # tokens stand in the order of the text, so a part's tokens are those that start before its end
            starts = np.fromiter((at for at, _ in found.offsets), np.int64, len(found))
            ends = (4 * np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))).tolist()
            packed = np.array(found.ids, "<u4").tobytes()
            ids.update(zip(some, [packed[a:b] for a, b in zip([0, *ends], ends)]))
        return ids

    def ids(self, column: pa.Array) -> Iterator[bytes]:
        """Packed ids of each text of a column; null is an empty text."""
        for _, data, offsets in A.blocks(column, TEXT):
            words = A.words(data, offsets)
            coded = A.word_strings(data, words).dictionary_encode()
            packed = pa.array(self.of(coded.dictionary.cast(pa.large_binary()).to_pylist()), pa.large_binary()).take(coded.indices)
            at = np.frombuffer(packed.buffers()[1], np.int64)[words.first] if len(packed) else words.first
            joined = packed.buffers()[2].to_pybytes() if len(packed) else b""
            for begin, end in zip(at[:-1].tolist(), at[1:].tolist()):
                yield joined[begin:end]


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Each document's ids and the end token, cut after every ``capacity`` ids.

    Columns: id, piece, start, length, ids (packed unsigned 32-bit, little-endian). The tokenizer (a file
    every machine has at that place) must treat words between ASCII white space separately, lower-case
    them, and split letters from marks.
    """
    source = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").cast("string").alias("__text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids binary"
    end, width = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = A.kept("packing", WordIds, path)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                texts = enumerate(table.ids(part.column("__text")))
                while some := list(islice(texts, OUT)):
                    rows, number, start, ids = [], [], [], []
                    for row, packed in some:
                        packed += end
                        for k, at in enumerate(range(0, len(packed), width)):
                            rows.append(row)
                            number.append(k)
                            start.append(at // 4)
                            ids.append(packed[at:at + width])
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(rows, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                         pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
                        [id_col, "piece", "start", "length", "ids"])
                A.give_back()

    return source.mapInArrow(run, schema)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece; lengths are from 1 to ``capacity``."""
    order = np.argsort(lengths, kind="stable")[::-1]
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in order[::-1].tolist():
        waiting[int(lengths[i])].append(i)
    present = np.array([bool(w) for w in waiting])
    sizes = np.arange(capacity + 1)
    below = np.maximum.accumulate(np.where(present, sizes, 0))  # largest waiting length up to each size

    def take(size: int) -> int:
        item = waiting[size].pop()
        if not waiting[size]:
            present[size] = False
            below[size:_next(size)] = below[size - 1]
        return item

    def put(item: int, size: int) -> None:
        waiting[size].append(item)
        if not present[size]:
            present[size] = True
            below[size:_next(size)] = size

    def _next(size: int) -> int:
        """The next waiting length above, or the end."""
        above = int(present[size + 1:].argmax()) + size + 1 if size < capacity else capacity + 1
        return above if above <= capacity and present[above] else capacity + 1

    bin_of, offset_of, number = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    while below[capacity]:
        gap, content = capacity, []
        while gap and (size := int(below[gap])):
            content.append((take(size), size))
            gap -= size
        if gap and below[capacity]:
            item, small = content[-1]  # lengths only fall within a bin
            room = gap + small
            one = np.flatnonzero(present[:room + 1])
            two = below[room - one]
            alone = np.array([len(waiting[s]) < 2 for s in one[two == one]], bool)
            same = np.flatnonzero(two == one)[alone]
            two[same] = below[one[same] - 1]
            both = np.where(two > 0, one + two, 0)
            best = int(both.argmax()) if len(both) else 0
            if len(both) and both[best] > small:
                content[-1:] = [(take(s), s) for s in (int(one[best]), int(two[best]))]
                put(item, small)
        at = 0
        for item, size in content:
            bin_of[item], offset_of[item] = number, at
            at += size
        number += 1
    return bin_of, offset_of


def _round(rows: DataFrame, capacity: int, shards: int, number: int) -> DataFrame:
    """Pack each shard; rows carry length and __row."""
    schema = rows.drop("__row").schema.add("sequence_id", "long").add("offset", "long").add("__full", "boolean")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["__shard"].iloc[0])
        group = group.sort_values("__row", kind="stable")
        lengths = group["length"].to_numpy(np.int64)
        bins, offsets = best_two_fit(lengths, capacity)
        filled = np.bincount(bins, weights=lengths)
        return group.drop(columns=["__shard", "__row"]).assign(
            sequence_id=(number << 60) + (shard << 24) + bins, offset=offsets, __full=filled[bins] >= FULL * capacity)

    shard = F.pmod(F.xxhash64("__row"), F.lit(shards))
    return rows.withColumn("__shard", shard).groupBy("__shard").applyInPandas(run, schema)


def pack(rows: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to rows with a ``length`` (1 to ``capacity``); the id is not dense."""
    numbered = saved(rows.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    first = saved(_round(numbered, capacity, numbered.count() // SHARD + 1, 0), "packed")
    done, rest = first.filter("__full"), first.filter("not __full").drop("sequence_id", "offset", "__full")
    again = _round(rest.withColumn("__row", F.monotonically_increasing_id()), capacity, rest.count() // SHARD + 1, 1)
    return done.unionByName(again).drop("__full")


def of_documents(docs: DataFrame, path: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """Place of every piece of every document, with a checksum of its ids."""
    cut = pieces(docs, path, end_id, capacity)
    return pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity)
