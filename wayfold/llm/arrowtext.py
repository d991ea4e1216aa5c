"""Column kernels on Arrow text: words, word hashes and word windows of whole batches at once.

A batch of texts is one UTF-8 buffer with offsets. Word bounds come from a table of byte classes, word hashes from prefix sums of
a polynomial modulo 2**64 (the multiplier is odd and so has an inverse), windows from a multilinear form over word hashes. No
Python loop runs over words. Memory is bounded by `limit` bytes of text a chunk; a longer text makes a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
_MULT = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULT, -1, 1 << 64)
_PIECE = 1 << 19
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
_WINDOW_MULTS = np.random.default_rng(577).integers(1, 1 << 63, 64, dtype=U64) * U64(2) + U64(1)

_FOLDED = _BYTE_VALUES.copy()
_FOLDED[65:91] = _BYTE_VALUES[97:123]

_NOT_SPACE = np.ones(256, bool)
_NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

_ALNUM = np.zeros(256, bool)
_ALNUM[0x30:0x3A] = _ALNUM[0x61:0x7B] = _ALNUM[0x41:0x5B] = True
_ALNUM[0x80:] = True


class WordKind(NamedTuple):
    """Which bytes make words, and the value of each byte in a word's hash."""

    member: np.ndarray
    values: np.ndarray


#: Runs without ASCII white space, case kept.
EXACT = WordKind(_NOT_SPACE, _BYTE_VALUES)
#: Runs without ASCII white space, A-Z folded.
FOLDED = WordKind(_NOT_SPACE, _FOLDED)
#: Runs of ASCII letters and digits and of all beyond ASCII, A-Z folded.
ALNUM = WordKind(_ALNUM, _FOLDED)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words (xor-shift and multiply, three rounds)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_powers_cache: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = _powers_cache.get("up")
    if up is None or len(up) < n:
        size = max(n, _PIECE + 1024)
        up, down = np.full(size, _MULT, U64), np.full(size, _INVERSE, U64)
        up[0] = down[0] = 1
        up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size > 1 << 22:  # a huge word: not worth keeping
            return up, down
        _powers_cache.update(up=up, down=down)
    return _powers_cache["up"], _powers_cache["down"]


class Words(NamedTuple):
    starts: np.ndarray  # byte offset in the chunk
    ends: np.ndarray
    hashes: np.ndarray  # uint64
    first: np.ndarray  # of each text, the index of its first word; one more at the end

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Of each word, the index of its text."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def bounds(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of the words; no word reaches over the end of a text."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = member[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = np.unique(offsets)
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    out, i, n = np.empty(len(starts), U64), 0, len(starts)
    while i < n:
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, low + _PIECE, "right")))
        high = int(ends[j - 1])
        up, down = _powers(high - low + 1)
        sums = np.zeros(high - low + 1, U64)
        np.cumsum(values[data[low:high]] * up[: high - low], out=sums[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[b] - sums[a]) * down[a] + (b - a).astype(U64)
        i = j
    return mix(out)


def words(data: np.ndarray, offsets: np.ndarray, kind: WordKind) -> Words:
    starts, ends = bounds(data, offsets, kind.member)
    return Words(starts, ends, word_hashes(data, starts, ends, kind.values), np.searchsorted(starts, offsets))


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Of each run of n neighbouring words, whatever text they belong to."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, U64)
    out = hashes[:count] * _WINDOW_MULTS[0]
    for k in range(1, n):
        out += hashes[k : k + count] * _WINDOW_MULTS[k % 64] if k < 64 else mix(hashes[k : k + count] + U64(k))
    return mix(out + U64(n))


def window_starts(first: np.ndarray, n: int) -> np.ndarray:
    """Indexes of the words that begin n words of one text."""
    counts = np.diff(first)
    room = np.maximum(counts - n + 1, 0)
    total = int(room.sum())
    base = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(room)[:-1])), room)
    return base + np.arange(total)


def covered(n_words: int, starts: np.ndarray, n: int) -> np.ndarray:
    """Which words lie in a window of n words that begins at one of `starts`."""
    steps = np.zeros(n_words + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + n, n_words), -1)
    return np.cumsum(steps[:-1]) > 0


class Chunk(NamedTuple):
    rows: pa.RecordBatch
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, from 0

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, np.uint8)[low:high] if data is not None and high > low else np.zeros(0, np.uint8)
    return raw, offsets - low


def gathered(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have `least` bytes, for kernels that gain by size."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= least:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def chunks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = 8 << 20) -> Iterator[Chunk]:
    """Batches cut so that a chunk has at most `limit` bytes of text, or one text."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        data, offsets = text_buffers(batch.column(at))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
            yield Chunk(batch.slice(i, j - i), data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            i = j
