"""Byte-level BPE as a transducer, and streaming decode with a UTF-8 state machine.

**Encoding.** The merges of a rank file are compiled into a finite-state transducer over bytes. Its
non-deterministic form reads tokens along a trie; a token may follow another only if the merges of the
two together give back exactly the two (then a sequence whose neighbours all agree is the merges'
result). It is determinised lazily: a state is a set of (trie node, token before); a step follows every
item over a byte and finds the one token that may end there. Tokens are emitted once no item reaches
back behind them; an item lives for at most the longest token, so the lookahead is bounded. States and
their steps, pairs of tokens, and the ids of chunks and pieces met before are kept in tables that are
dropped when they exceed ``MAX_STATES``, ``MAX_PAIRS`` and ``MAX_CHUNKS``; results don't depend on that.

**Decoding.** Tokens are joined in chunks; a UTF-8 automaton, lifted lazily from bytes to tokens, tells
at which token the text is at the end of a code point, so a chunk is given out only when it is whole.

Defined results: null and empty texts give no ids, and no ids give no bytes; text is never cut; other
columns pass through unless the output's name hides them; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import gc
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate
from operator import getitem

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemark.llm import arrays as A

MAX_STATES = 100_000
MAX_PAIRS = 400_000
MAX_CHUNKS = 200_000
LONGEST_KEPT = 64
BITS = 20
MASK = (1 << BITS) - 1
CHUNK = 4096


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class State(dict):
    """A set of items, the token that ends where it is reached (-1: none), and the next state by byte."""

    __slots__ = ("items", "last", "step")

    @classmethod
    def of(cls, items: tuple, last: int, step) -> "State":
        state = cls()
        state.items, state.last, state.step = items, last, step
        return state

    def __missing__(self, byte: int) -> "State":
        found = self[byte] = self.step(self.items, byte)
        return found


class Transducer:
    """Lazily determinised transducer from bytes to token ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: token for token, i in ranks.items()}
        self.size = {i: len(token) for token, i in ranks.items()}
        child: dict[int, int] = {}
        inner, token_at = {0}, {}
        for token, i in ranks.items():
            node = 0
            for byte in token:
                inner.add(node)
                node = child.setdefault(node << 8 | byte, len(child) + 1)
            token_at[node] = i
        # trie: node * 256 + byte -> node * 2 + whether it goes on; token that ends at a node, or -1
        self.child = {k: node << 1 | (node in inner) for k, node in child.items()}
        self.token_at = [token_at.get(node, -1) for node in range(len(child) + 1)]
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.agreed: dict[int, bool] = {}
        self.states: dict[tuple, State] = {}
        self._reset()

    def _reset(self) -> None:
        """An item is node << BITS | token before + 1 (0: none)."""
        for state in self.states.values():
            state.clear()  # states refer to each other
        self.start = State.of((0,), -1, self._step)
        self.states = {self.start.items: self.start}

    def merge(self, piece: bytes, stop: int = 1) -> list[int]:
        """Apply the merges to a short piece, lowest rank first, leftmost of equal ones."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > stop:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None if the merges don't lead to it."""
        if token not in self.parts:
            pair = self.merge(self.bytes_of[token], stop=2)
            self.parts[token] = (pair[0], pair[1]) if len(pair) == 2 else None
        return self.parts[token]

    def agree(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' bytes give back just these two.

        The two are taken apart along the border, the younger one first. At each moment the pair at the
        border must not have been due before the merge that came next on either side.
        """
        if self.size[right] > 1 and self.halves(right) is None:
            return False
        due_left = due_right = 1 << 60
        rank_of, bytes_of, size = self.ranks.get, self.bytes_of, self.size
        while True:
            rank = rank_of(bytes_of[left] + bytes_of[right])
            if rank is not None and rank < due_left and rank <= due_right:
                return False
            if left > right and size[left] > 1 or size[right] == 1:
                if size[left] == 1:
                    return True
                due_left, left = left, self.halves(left)[1]
            else:
                due_right, right = right, self.halves(right)[0]

    def _fits(self, before: int, token: int) -> bool:
        """Whether a token may follow the one before it (plus 1; 0: none)."""
        pair = before << BITS | token
        fits = self.agreed.get(pair)
        if fits is None:
            if len(self.agreed) >= MAX_PAIRS:
                self.agreed.clear()
            fits = self.agreed[pair] = self.agree(before - 1, token) if before else (
                self.size[token] == 1 or self.halves(token) is not None)
        return fits

    def _end(self, state: State, byte: int) -> int:
        """The token that ends where a step over a byte leads to, without that state."""
        if byte in state:
            return state[byte].last
        child, token_at = self.child.get, self.token_at
        for item in state.items:
            to = child(item >> BITS << 8 | byte)
            if to is not None:
                token = token_at[to >> 1]
                if token >= 0 and self._fits(item & MASK, token):
                    return token
        return -1

    def _step(self, reached: tuple, byte: int) -> State:
        """Follow every item over a byte, find the token that ends here, and the state of the set of items."""
        items, last, child, token_at = [], -1, self.child.get, self.token_at
        for item in reached:
            to = child(item >> BITS << 8 | byte)
            if to is None:
                continue
            before = item & MASK
            if last < 0:
                token = token_at[to >> 1]
                if token >= 0 and self._fits(before, token):
                    last = token
            if to & 1:
                items.append(to >> 1 << BITS | before)
        items.append(last + 1)
        key = tuple(items)
        state = self.states.get(key)
        if state is None:
            state = self.states[key] = State.of(key, last, self._step)
        return state

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece of text; a piece that is itself a token is that token.

        Each state knows the token that ends there. Where a state has one item only, nothing that
        follows can change the tokens before it, and they are emitted.
        """
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > MAX_STATES:
            self._reset()
        if len(piece) <= LONGEST_KEPT:
            # nothing follows the last byte, so its state need not be made
            path = list(accumulate(piece[:-1], getitem, initial=self.start))
            token = self._end(path[-1], piece[-1])
            return [*self._emit(path[:len(path) + 1 - self.size[token]]), token]
        state, path, out = self.start, [self.start], []
        for byte in piece:
            state = state[byte]
            path.append(state)
            if len(path) > LONGEST_KEPT and len(state.items) == 1:
                out += self._emit(path)
                path = [state]
        return out + self._emit(path)

    def _emit(self, path: list[State]) -> list[int]:
        """Tokens along the path after its first state, read from its end."""
        out, at, size = [], len(path) - 1, self.size
        while at:
            token = path[at].last
            out.append(token)
            at -= size[token]
        out.reverse()
        return out


# The Unicode white space characters, as a class body.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Words with the blank before them, or white space. No match of a splitting pattern of the usual kind
# (a blank may lead a piece, else white space stands alone) reaches over the border of two such chunks.
CHUNKS = f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"


class Lately(dict):
    """Packed ids (int32, little-endian) of the texts met lately, in two generations."""

    def __init__(self):
        super().__init__()
        self.older = {}

    def __missing__(self, text: str) -> bytes:
        packed = self.older.get(text)
        if packed is None:
            packed = self.made(text)
        if len(self) >= MAX_CHUNKS:
            self.older = dict(self)
            self.clear()
        if len(text) <= LONGEST_KEPT:
            self[text] = packed
        return packed


class Pieces(Lately):
    """Pieces are fewer than chunks, as marks stand in pieces of their own."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer

    def made(self, piece: str) -> bytes:
        return array("i", self.transducer.encode(piece.encode())).tobytes()


class Chunks(Lately):
    """Chunks are split into pieces by the pattern."""

    def __init__(self, transducer: Transducer, pattern: str):
        super().__init__()
        self.pieces, self.split = Pieces(transducer), regex.compile(pattern).findall

    def made(self, chunk: str) -> bytes:
        found = self.split(chunk)
        return self.pieces[chunk] if found == [chunk] else b"".join(map(self.pieces.__getitem__, found))


# UTF-8 automaton. State 0: between code points; 1 to 3: so many continuation bytes to come;
# 4 to 7: the next byte is restricted (after E0, ED, F0, F4); 8: not UTF-8.
BROKEN = 8
_RESTRICTED = {4: (0xA0, 0xBF, 1), 5: (0x80, 0x9F, 1), 6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2)}
_FIRST = {0xE0: 4, 0xED: 5, 0xF0: 6, 0xF4: 7}


def next_state(state: int, byte: int) -> int:
    """The automaton's step over one byte."""
    if state == 0:
        if byte < 0x80:
            return 0
        if byte in _FIRST:
            return _FIRST[byte]
        return 1 if 0xC2 <= byte <= 0xDF else 2 if 0xE1 <= byte <= 0xEF else 3 if 0xF1 <= byte <= 0xF3 else BROKEN
    if state in _RESTRICTED:
        low, high, to = _RESTRICTED[state]
        return to if low <= byte <= high else BROKEN
    return state - 1 if state < 4 and 0x80 <= byte <= 0xBF else BROKEN


class Decoder:
    """Streaming decode: every ``feed`` gives out the bytes of whole code points and keeps the rest."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.lifted: list[dict[int, int]] = [Lifted(s, bytes_of) for s in range(BROKEN + 1)]
        self.open = np.zeros(max(bytes_of, default=-1) + 1, bool)  # tokens that begin at a code point and don't end at one
        self.open[[i for i in bytes_of if self.lifted[0][i]]] = True
        self.reset()

    def reset(self) -> None:
        self.state, self.kept = 0, []

    def feed(self, ids: Iterable[int]) -> bytes:
        """Bytes up to the last place where the text is whole; broken bytes are given out as they are."""
        if not isinstance(ids, np.ndarray):
            ids = np.array(list(ids), np.int64)
        state, lifted, whole, at = self.state, self.lifted, -1, 0
        stops, tokens = iter([*np.flatnonzero(self.open[ids]).tolist(), len(ids)]), ids.tolist()
        stop = next(stops)
        while at < len(tokens):
            if state == 0:  # up to the next open token every token ends at the end of a code point
                while stop < at:
                    stop = next(stops)
                if stop > at:
                    whole, at = stop - 1, stop
                    continue
            state = lifted[state][tokens[at]]
            if state == 0 or state == BROKEN:
                state, whole = 0, at
            at += 1
        self.state = state
        tokens = list(map(self.bytes_of.__getitem__, tokens))
        if whole < 0:
            self.kept += tokens
            return b""
        out = b"".join(self.kept) + b"".join(tokens[:whole + 1])
        self.kept = tokens[whole + 1:]
        return out

    def finish(self) -> bytes:
        """What an unfinished code point has left."""
        out = b"".join(self.kept)
        self.reset()
        return out


class Lifted(dict):
    """The automaton's step from one state over a whole token, filled as tokens come."""

    def __init__(self, state: int, bytes_of: dict[int, bytes]):
        super().__init__()
        self.state, self.bytes_of = state, bytes_of

    def __missing__(self, token: int) -> int:
        state = self.state
        for byte in self.bytes_of[token]:
            state = next_state(state, byte) if state != BROKEN else BROKEN
        self[token] = state
        return state


def _encoder(path: str, pattern: str, chunks: str):
    """One splitter and chunk table for each Python worker."""
    return re.compile(chunks).findall, Chunks(Transducer(read_ranks(path)), pattern)


def _decoder(path: str) -> Decoder:
    return Decoder({i: token for token, i in read_ranks(path).items()})


def _sliced(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for first in range(0, batch.num_rows, rows):
        yield batch.slice(first, rows)


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], column], [*names, name])


Batches = Iterator[pa.RecordBatch]


def _encoding(path: str, pattern: str, chunks: str, out: str) -> Callable[[Batches], Batches]:
    """Replace the texts of a column by their ids, batch by batch."""
    def run(batches: Batches) -> Batches:
        split, table = A.kept("bpe", _encoder, path, pattern, chunks)
        gc.disable()  # it would walk the tables, whose only cycles are those that _reset takes apart
        try:
            for batch in batches:
                for part in _sliced(batch):
                    packed = [b"".join(map(table.__getitem__, split(text))) if text else b"" for text in part.column(out).to_pylist()]
                    ends = np.cumsum([0, *[len(p) // 4 for p in packed]])
                    flat = pa.array(np.frombuffer(b"".join(packed), "<i4"))
                    yield _with(part, out, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat))
        finally:
            gc.enable()
    return run


def _decoding(path: str, ids_col: str, out: str) -> Callable[[Batches], Batches]:
    """Add the bytes that a column of ids stands for, batch by batch."""
    def run(batches: Batches) -> Batches:
        decoder = A.kept("bpe", _decoder, path)
        for batch in batches:
            for part in _sliced(batch):
                found = []
                for ids in part.column(ids_col):
                    ids = ids.values.to_numpy() if ids.is_valid else np.zeros(0, np.int32)
                    stream = [decoder.feed(ids[k:k + CHUNK]) for k in range(0, len(ids), CHUNK)]
                    found.append(b"".join([*stream, decoder.finish()]))
                yield _with(part, out, pa.array(found, pa.binary()))
    return run


def _texts(docs: DataFrame, text_col: str, out: str) -> tuple[DataFrame, StructType]:
    """The rows with the text under the output's name, and the schema with ids there instead."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (text_col, out)]
    source = docs.select(*kept, F.col(f"`{text_col}`").cast("string").alias(out))
    return source, source.select(*kept, F.expr("cast(null as array<int>)").alias(out)).schema


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", out: str = "ids",
           chunks: str = CHUNKS) -> DataFrame:
    """Replace the text column by the ids (array of int) of the whole text.

    ``path`` is a rank file that every machine has at that place; ``pattern`` splits the text into the
    pieces that are merged separately; ``chunks`` splits it more coarsely, at borders of pieces.
    """
    source, schema = _texts(docs, text_col, out)
    return source.mapInArrow(_encoding(path, pattern, chunks, out), schema)


def decode(docs: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the decoded bytes of the ids, joined from the stream's whole code points."""
    kept = [c for c in docs.columns if c != out]
    source = docs.select(*[F.col(f"`{c}`") for c in kept])
    return source.mapInArrow(_decoding(path, ids_col, out), source.select(*kept, F.lit(b"").alias(out)).schema)


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text", out: str = "ids",
               decoded: str = "decoded", chunks: str = CHUNKS) -> DataFrame:
    """``encode``, and ``decode`` of the ids so made, in one pass: a task has one Python worker instead of two."""
    source, schema = _texts(docs.drop(decoded) if text_col != decoded else docs, text_col, out)
    encoding, decoding = _encoding(path, pattern, chunks, out), _decoding(path, out, decoded)
    return source.mapInArrow(lambda batches: decoding(encoding(batches)), schema.add(decoded, "binary", False))


def of_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Digests of every document's ids and of the bytes decoded from them."""
    coded = round_trip(docs.select("doc_id", "text"), path, pattern)
    joined = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                        F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
