"""Words and hashes of whole columns of texts, in numpy.

A column's UTF-8 bytes are looked at as one array.  Words are hashed eight bytes
at a time, all words in step; a long word is hashed by blake2b.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa

_SEED = np.uint64(0x9E3779B97F4A7C15)
_STEP_1 = np.uint64(0xD6E8FEB86659FD93)
_STEP_2 = np.uint64(0xC2B2AE3D27D4EB4F)
#: Longer ranges of bytes are hashed by hashlib.
_SHORT = 128
#: Ranges looked at in one go, so that the arrays in between stay small.
_AT_ONCE = 1 << 15

#: Bytes of the two kinds of words; all bytes of non-ASCII characters belong to words.
_BYTES = np.arange(256)
NOT_SPACE = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
ALNUM = (
    ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)

def mix(x: np.ndarray) -> np.ndarray:
    """Murmur3's 64-bit finaliser: a bijection that spreads all bits."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(33))
        x = x * np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(33)
    return x


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts (null: empty), and each text's first byte (with one more entry at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no chunks
            column = pa.array([], pa.large_string())
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if n and raw else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


class Texts:
    """A column of texts (null: empty) as bytes and as hashed words.

    ``offsets`` has each text's first byte, ``start``/``end`` each word's bytes
    and ``first`` each text's first word (with one more entry at the end).
    """

    def __init__(self, column: pa.Array | pa.ChunkedArray, word_bytes: np.ndarray = NOT_SPACE, lower: bool = False):
        data, self.offsets = column_bytes(column)
        self.data = LOWER[data] if lower else data
        self._find(word_bytes[data])

    def _find(self, inside: np.ndarray) -> None:
        first_of = inside.copy()
        first_of[1:] &= ~inside[:-1]
        last_of = inside.copy()
        last_of[:-1] &= ~inside[1:]
        cuts = self.offsets[(self.offsets > 0) & (self.offsets < len(inside))]
        first_of[cuts] = inside[cuts]
        last_of[cuts - 1] = inside[cuts - 1]
        self.start = np.flatnonzero(first_of)
        self.end = np.flatnonzero(last_of) + 1
        self.first = np.searchsorted(self.start, self.offsets)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.n_words)

    def place_in_text(self) -> np.ndarray:
        return np.arange(len(self.start)) - np.repeat(self.first[:-1], self.n_words)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; different seeds give independent ones."""
        return range_hashes(self.data, self.start, self.end, seed)


def distinct(keys: np.ndarray):
    """Distinct keys, an example of each and which of them every entry has (``np.unique`` sorts stably, which takes longer)."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    return ordered[new], order[new], which


def _eights(data: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """Reads the eight bytes from each of some places on (zeros past the end) as one number."""
    padded = np.zeros((len(data) // 8 + 2) * 8, np.uint8)
    padded[: len(data)] = data
    words = padded.view("<u8")

    def read(at: np.ndarray) -> np.ndarray:
        word, bits = at >> 3, ((at & 7) << 3).astype(np.uint64)
        # two shifts, as one by 64 is not defined
        return (words[word] >> bits) | ((words[word + 1] << np.uint64(1)) << (np.uint64(63) - bits))

    return read


_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def _step(state: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Takes the next value into a hash; not linear in either, so patterns don't cancel out."""
    with np.errstate(over="ignore"):
        x = (state ^ (state >> np.uint64(31))) * _STEP_1 + value
        x ^= x >> np.uint64(32)
        x *= _STEP_2
        x ^= x >> np.uint64(29)
    return x


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each of some ranges of bytes."""
    read, out = _eights(data), np.empty(len(start), np.uint64)
    for a in range(0, len(start), _AT_ONCE):
        some = slice(a, a + _AT_ONCE)
        out[some] = _hashes(data, read, start[some], end[some], seed)
    return out


def _hashes(data: np.ndarray, read: Callable, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    size = end - start
    with np.errstate(over="ignore"):
        out = mix(np.full(1, seed, np.uint64)) + _SEED + size.astype(np.uint64)
    left = np.flatnonzero(size <= _SHORT)
    offset = 0
    while len(left):
        value = read(start[left] + offset) & _KEEP[np.minimum(size[left] - offset, 8)]
        out[left] = _step(out[left], value)
        offset += 8
        left = left[size[left] > offset]
    for i in np.flatnonzero(size > _SHORT).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]], digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")
    return mix(out)


def same_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray, other_start: np.ndarray) -> np.ndarray:
    """Which ranges of bytes equal those of the same length that start at ``other_start`` in ``other``."""
    one = _eights(data)
    two = one if other is data else _eights(other)
    same = np.empty(len(start), bool)
    for a in range(0, len(start), _AT_ONCE):
        some = slice(a, a + _AT_ONCE)
        same[some] = _same(data, one, start[some], end[some] - start[some], other, two, other_start[some])
    return same


def _same(data: np.ndarray, one: Callable, start: np.ndarray, size: np.ndarray, other: np.ndarray, two: Callable, other_start: np.ndarray):
    same = np.ones(len(start), bool)
    left, offset = np.flatnonzero(size > 0), 0
    while len(left):
        keep = _KEEP[np.minimum(size[left] - offset, 8)]
        fits = ((one(start[left] + offset) ^ two(other_start[left] + offset)) & keep) == 0
        same[left[~fits]] = False
        offset += 8
        left = left[fits]
        left = left[size[left] > offset]
        if offset >= 8 * _SHORT:
            for i in left.tolist():
                a, b = int(start[i]), int(other_start[i])
                same[i] = np.array_equal(data[a : a + size[i]], other[b : b + size[i]])
            break
    return same


class Windows:
    """Hashes of runs of word hashes.

    The hash of a run is put together from those of runs of 1, 2, 4, .. items,
    which are made from each other by doubling.
    """

    def __init__(self, word_hashes: np.ndarray, second: bool = False):
        with np.errstate(over="ignore"):
            self._items = mix(word_hashes + np.uint64(0x5851F42D4C957F2D)) if second else word_hashes

    def at(self, start: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        """The hash of ``length`` items from each start; all runs lie inside the items."""
        if isinstance(length, np.ndarray):
            out = np.empty(len(start), np.uint64)
            for n in np.unique(length).tolist():
                chosen = length == n
                out[chosen] = self.at(start[chosen], n)
            return out
        runs, size, at = self._items, 1, start
        out = np.full(len(start), _SEED)
        while size <= length:
            if length & size:
                out = _step(out, runs[at]) if len(at) else out
                at = at + size
            if 2 * size <= length:
                runs = _step(runs[:-size], runs[size:])
            size *= 2
        with np.errstate(over="ignore"):
            return mix(out + np.uint64(length))


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of ``n`` places lie under any of the given runs."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0
