"""Numpy kernels over the UTF-8 buffers of Arrow text columns: words, lines, hashes, per-document sums.

Texts are handled in blocks of about ``BLOCK`` bytes that end at a document's end, so the memory of a
task is bounded by one block (or by its longest text).
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_GRAM = U(0xD6E8FEB86659FD93 | 1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers = [np.ones(1, U), np.ones(1, U)]
_kept: dict[tuple, object] = {}


def kept(owner: str, make: Callable, *arguments):
    """What ``make`` gives, kept in this worker for the owner's next tasks; what other owners kept is given up."""
    if any(name != owner for name, *_ in _kept):
        release()
    key = (owner, make, *arguments)
    if key not in _kept:
        _kept[key] = make(*arguments)
    return _kept[key]


def release() -> None:
    """Give up what earlier tasks kept, and freed memory: workers live on, and it would count in the next stage."""
    _kept.clear()
    gc.collect()
    give_back()


def give_back() -> None:
    """Give freed memory back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library has it
    if trim:
        trim(0)


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a text column; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(column, size: int = BLOCK) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for each block of a text column."""
    data, offsets = buffers(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield slice(first, last), data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, in place."""
    h ^= h >> U(30)
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64; long texts get a table that is not kept."""
    if len(_powers[0]) < n:
        made = []
        for base in (_BASE, _BASE_INVERSE):
            p = np.full(n, base, U)
            p[0] = 1
            made.append(np.cumprod(p, dtype=U))
        if n > 4 * BLOCK:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0], _powers[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes: differences of one running polynomial hash, then mixed."""
    power, inverse = _power(len(data) + 1)
    running = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * power[:len(data)], out=running[1:])
    h = (running[ends] - running[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(U) * U(0xA24BAED4963EE407))


@dataclass
class Words:
    """Words of a block: byte spans, and the word numbers at which each document begins."""
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> Words:
    """Runs of bytes that are no ASCII white space (or not in ``space``); they end at a document's end."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~space[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    begins[cuts] |= inside[cuts]
    starts = np.flatnonzero(begins)
    stops = ~inside
    stops[offsets[1:]] = True
    stop_at = np.flatnonzero(stops)
    ends = stop_at[np.searchsorted(stop_at, starts, "right")]
    return Words(starts, ends, np.searchsorted(starts, offsets))


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of each span as an array of strings."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[at])))


def word_strings(data: np.ndarray, found: Words, space: np.ndarray = SPACE) -> pa.Array:
    """The words of a block as an array of strings; ``space`` as they were found with."""
    offsets = np.concatenate([[0], np.cumsum(found.ends - found.starts)])
    return pa.LargeStringArray.from_buffers(len(found.starts), pa.py_buffer(offsets), pa.py_buffer(data[~space[data]]))


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive items; one entry for each of the len(h) - n + 1 starts."""
    if len(h) < n:
        return np.zeros(0, U)
    out = h[:len(h) - n + 1].copy()
    for k in range(1, n):
        out *= _GRAM
        out += h[k:len(h) - n + 1 + k]
    return mix(out + U(n))


def within(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Flags of the starts whose run of n items stays in one document; ``first`` as in ``Words``."""
    size = max(total - n + 1, 0)
    doc_end = np.repeat(first[1:], np.diff(first))[:size]
    return np.arange(size) + n <= doc_end


def owner(first: np.ndarray) -> np.ndarray:
    """Document number of each item."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of each document's items."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def repeats(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items (hash, document): whether an equal one exists in the document, and whether one came before."""
    again, before = np.zeros(len(key), bool), np.zeros(len(key), bool)
    if len(key) == 0:
        return again, before
    own = mix(key + doc.astype(U) * U(0xC2B2AE3D27D4EB4F))
    order = np.argsort(own)
    ordered = own[order]
    heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    sizes = np.diff(np.append(heads, len(key)))
    first = np.repeat(np.minimum.reduceat(order, heads), sizes)
    again[order] = np.repeat(sizes > 1, sizes)
    before[order] = order != first
    return again, before


def code_points(data: np.ndarray) -> np.ndarray:
    """Flags of the bytes that begin a code point."""
    return (data & 0xC0) != 0x80
