"""Token ids of whole texts, by a public tokenizer of the ``tokenizers`` library.

Byte-level tokenizers of this kind cut a text into pieces that never reach
from a non-space character into the white space after it, nor from a letter
into the punctuation after it.  So the ids of a text are the ids of its *chunks*
(white space and the run of other characters after it, or the punctuation
after letters) one after the other.  Each distinct chunk is encoded only once
per batch, and remembered by the worker, with its bytes.  When there are more
than ``REMEMBER`` chunks, those that were met only once are forgotten.  Chunks
are looked up by a hash and compared (:func:`_same`).  A chunk never begins
after a character that might be non-ASCII white space.

New chunks of letters, with or without a space before, are one piece for the
tokenizer's pattern, so its model gets them without that pattern
(:func:`_of_words`).  Other new chunks of a batch that begin with a space and end
in printable ASCII can be encoded as one text; the ids' lengths in bytes tell
where each chunk's ids end.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from adevents.llm.words import NOT_SPACE, column_bytes, range_hashes, same_ranges
from adevents.llm.words import distinct as _distinct

END_ID = 2
REMEMBER = 1_000_000
#: Chunks that the tokenizer gets in one call; its results take far more room than the ids.
_CALL = 5_000

#: The character that a byte-level vocabulary writes for each byte.
_WRITTEN = np.arange(256, dtype="<u4")
_HIDDEN = ~((_WRITTEN >= 0x21) & (_WRITTEN <= 0x7E) | (_WRITTEN >= 0xA1) & (_WRITTEN != 0xAD))
_WRITTEN[_HIDDEN] = 256 + np.arange(_HIDDEN.sum())

_TOKENIZERS: dict[str, object] = {}
_WORD_TOKENIZERS: dict[str, object] = {}
_MEMORY: dict[str, _Memory] = {}
_LENGTHS: dict[str, np.ndarray] = {}


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    if path not in _TOKENIZERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


def _lengths(path: str) -> np.ndarray:
    """The number of bytes of every id."""
    if path not in _LENGTHS:
        tok = load(path)
        out = np.zeros(tok.get_vocab_size(), np.int64)
        special = {i: t.content for i, t in tok.get_added_tokens_decoder().items()}
        for token, i in tok.get_vocab().items():
            # a byte-level vocabulary writes each byte as one character
            out[i] = len(special[i].encode()) if i in special else len(token)
        _LENGTHS[path] = out
    return _LENGTHS[path]


def _same(data: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray, other_start: np.ndarray, other_size: np.ndarray) -> np.ndarray:
    """Whether chunks of equal hashes are equal.

    Each step of a hash is invertible, so up to eight bytes (one step) chunks of
    one size and hash are equal, and only longer ones are compared byte by byte.
    """
    size = end - start
    same = size == other_size
    longer = np.flatnonzero(same & (size > 8))
    if len(longer):
        same[longer] = same_ranges(data, start[longer], end[longer], other, other_start[longer])
    return same


class _Memory:
    """Chunks met before: their hashes, and each one's bytes and ids in long arrays.

    A chunk's number is found in a table of slots, from the slot that its hash
    names on, in the first of the next ones that isn't another chunk's.  Arrays
    have room for more at their end, which ``_room`` keeps.
    """

    def __init__(self):
        self._room: dict[str, np.ndarray] = {}
        self.keys = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.data = np.zeros(0, np.uint8)
        self.start = np.zeros(0, np.uint32)
        self.count = np.zeros(0, np.uint32)
        self.ids = np.zeros(0, np.uint16)
        self.again = np.zeros(0, bool)  # met again after the batch that brought it
        self.slots = np.full(1 << 10, -1, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each hash's chunk, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        last = len(self.slots) - 1
        slot = (keys & np.uint64(last)).astype(np.int64)
        at = self.slots.take(slot).astype(np.int64)
        left = np.flatnonzero((self.keys.take(at, mode="clip") != keys) & (at >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & last
            at[left] = self.slots[slot[left]]
            left = left[at[left] >= 0]
            left = left[self.keys[at[left]] != keys[left]]
        return at

    def holds(self, at: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether the chunks at these numbers have the same bytes as the given ones."""
        return _same(data, start, end, self.data, self.place[at], self.size[at])

    def add(self, keys: np.ndarray, data: np.ndarray, place: np.ndarray, size: np.ndarray, count: np.ndarray, ids: np.ndarray, order: np.ndarray) -> None:
        """Takes in chunks with new, distinct keys; counts and ids come in ``order``."""
        n = len(self.keys)
        counts, first = np.empty((2, len(keys)), np.uint32)
        counts[order], first[order] = count, len(self.ids) + np.cumsum(count) - count
        columns = {"keys": keys, "place": len(self.data) + place, "size": size, "data": data}
        columns |= {"start": first, "count": counts, "ids": ids, "again": np.zeros(len(keys), bool)}
        for name, values in columns.items():
            self._append(name, values)
        if 2 * len(self.keys) > len(self.slots):
            self.slots, n = np.full(1 << (4 * len(self.keys)).bit_length(), -1, np.int32), 0
        self._enter(n)

    def _append(self, name: str, values: np.ndarray) -> None:
        held = getattr(self, name)
        n, room = len(held), self._room.get(name, held)
        if n + len(values) > len(room):
            self._room[name] = room = np.empty(2 * (n + len(values)), held.dtype)
            room[:n] = held
        room[n : n + len(values)] = values
        setattr(self, name, room[: n + len(values)])

    def _enter(self, first: int) -> None:
        """Gives the chunks from a number on their slots."""
        last = len(self.slots) - 1
        number = np.arange(first, len(self.keys), dtype=np.int32)
        slot = (self.keys[first:] & np.uint64(last)).astype(np.int64)
        while len(number):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = number[free]  # of several, one gets it
            left = self.slots[slot] != number
            number, slot = number[left], (slot[left] + 1) & last

    def forget(self) -> None:
        """Leaves the chunks that were met again, if these are at most half of what may be remembered, else none."""
        self._room.clear()
        kept = np.flatnonzero(self.again)
        if len(kept) > REMEMBER // 2:
            kept = kept[:0]
        self.data, self.place = _ranges(self.data, self.place[kept], self.size[kept])
        self.ids, start = _ranges(self.ids, self.start[kept].astype(np.int64), self.count[kept].astype(np.int64))
        self.start = start.astype(np.uint32)
        self.keys, self.size, self.count = self.keys[kept], self.size[kept], self.count[kept]
        self.again = np.zeros(len(kept), bool)
        self.slots.fill(-1)
        self._enter(0)


def _ranges(values: np.ndarray, start: np.ndarray, size: np.ndarray):
    """Some ranges of an array one after the other, and where each begins."""
    upto = np.cumsum(size)
    return values[np.arange(upto[-1] if len(upto) else 0) + np.repeat(start - (upto - size), size)], upto - size


def _within(data: np.ndarray, first: int, last: int) -> np.ndarray:
    """Which bytes lie between two (arithmetic on bytes is much faster than looking each up)."""
    return (data - np.uint8(first)) <= np.uint8(last - first)


def _chunk_starts(data: np.ndarray, offsets: np.ndarray, specials: list[bytes]) -> np.ndarray:
    space = (data == 32) | _within(data, 9, 13)
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    at = np.flatnonzero(begins)
    at = at[at > 0]
    one, two = data[at - 1], data[np.maximum(at - 2, 0)]
    # After printable ASCII, or a two-byte character from U+00C0 on, none of which is white space.
    safe = ((one >= 0x21) & (one <= 0x7E)) | ((one >= 0x80) & (two >= 0xC3) & (two <= 0xDF))
    cuts = np.zeros(len(data), bool)
    cuts[at[safe]] = True
    raw = data.tobytes()
    if not any(s in raw for s in specials):  # else letters and punctuation may be one special token
        letter = _within(data | np.uint8(32), 0x61, 0x7A)
        punctuation = _within(data, 0x21, 0x7E) & ~letter & ~_within(data, 0x30, 0x39)
        cuts[1:] |= letter[:-1] & punctuation[1:]
    cuts[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cuts)


def _letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to letters up to U+023F (all characters from U+00C0 on but two)."""
    lead = _within(data, 0xC3, 0xC8)
    second = np.zeros(len(data), bool)
    second[1:] = lead[:-1]
    times = np.zeros(len(data), bool)  # U+00D7 and U+00F7
    times[1:] = (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    return (_within(data | np.uint8(32), 0x61, 0x7A) | lead | second) & ~times


def _of_words(path: str):
    """A tokenizer with the same model for words that are written as in its vocabulary, with spaces between, or None.

    A word is letters, perhaps after a space: the tokenizer of the path takes it
    for one piece, if it is a plain byte-level one, so this one's ids are the same.
    """
    if path not in _WORD_TOKENIZERS:
        from tokenizers import Tokenizer, models, pre_tokenizers

        tok, kept = load(path), None
        plain = isinstance(tok.model, models.BPE) and tok.normalizer is None and isinstance(tok.pre_tokenizer, pre_tokenizers.ByteLevel)
        if plain and tok.pre_tokenizer.use_regex and not tok.pre_tokenizer.add_prefix_space:
            added = [np.frombuffer(t.content.encode(), np.uint8) for t in tok.get_added_tokens_decoder().values()]
            affixes = tok.model.continuing_subword_prefix or tok.model.end_of_word_suffix
            if not affixes and not any(_letters(x)[1:].all() for x in added):
                kept = Tokenizer(tok.model)
                kept.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        _WORD_TOKENIZERS[path] = kept
    return _WORD_TOKENIZERS[path]


def _encode_chunks(data: np.ndarray, start: np.ndarray, end: np.ndarray, path: str):
    """Numbers of ids and the ids of chunks, in any order: ``(order, counts, ids)``."""
    tok, of_words, last = load(path), _of_words(path), data[end - 1]
    other = np.concatenate([[0], np.cumsum(~_letters(data))])
    word = (other[end] - other[start] == (data[start] == 32)) & (last != 32)
    if of_words is None:
        word[:] = False
    joins = ~NOT_SPACE[data[start]] & (last >= 0x21) & (last <= 0x7E) & ~word
    together, alone = np.flatnonzero(joins), np.flatnonzero(~(joins | word))
    words = np.flatnonzero(word)
    raw = data.tobytes()
    counts, ids = [], []
    for tokenizer, chosen in ((of_words, words), (tok, together)):
        for a in range(0, len(chosen), _CALL):
            some = chosen[a : a + _CALL]
            size = end[some] - start[some]
            text, upto = _ranges(data, start[some], size)[0], np.cumsum(size)
            if tokenizer is tok:
                text = text.tobytes().decode("utf-8")
            else:
                text = np.insert(_WRITTEN[text], upto[:-1], 32).tobytes().decode("utf-32-le")
            found = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint16)
            last_id = np.searchsorted(np.cumsum(_lengths(path)[found]), upto)
            counts.append(np.diff(last_id, prepend=-1))
            ids.append(found)
    texts = [raw[i:j].decode("utf-8") for i, j in zip(start[alone].tolist(), end[alone].tolist())]
    for a in range(0, len(texts), _CALL):
        found = [e.ids for e in tok.encode_batch_fast(texts[a : a + _CALL], add_special_tokens=False)]
        counts.append(np.array([len(x) for x in found]))
        ids.append(np.array([i for x in found for i in x], np.uint16))
    none = [np.zeros(0, np.int64)]
    return np.concatenate([words, together, alone]), np.concatenate(counts or none), np.concatenate(ids or none).astype(np.uint16)


def _encode_alone(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`encode`, text by text."""
    ids = [e.ids for e in load(path).encode_batch_fast([x or "" for x in column.to_pylist()], add_special_tokens=False)]
    return np.array([i for x in ids for i in x], np.uint16), np.array([len(x) for x in ids], np.int64)


def encode(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a column (null: empty) in one array, and each text's number of ids."""
    data, offsets = column_bytes(column)
    specials = [t.content.encode() for t in load(path).get_added_tokens_decoder().values()]
    start = _chunk_starts(data, offsets, specials)
    end = np.append(start[1:], len(data))
    keys = range_hashes(data, start, end)
    memory = _MEMORY.setdefault(path, _Memory())
    at = memory.find(keys)
    known = at >= 0
    memory.again[at[known]] = True
    if not known.all():
        if len(memory.keys) > REMEMBER:
            memory.forget()
            at = memory.find(keys)
        new = np.flatnonzero(at < 0)
        added, example, which = _distinct(keys[new])
        at[new] = len(memory.keys) + which
        example = new[example]
        size = end[example] - start[example]
        bytes_, place = _ranges(data, start[example], size)
        order, counts, ids = _encode_chunks(bytes_, place, place + size, path)
        memory.add(added, bytes_, place, size, counts, ids, order)
    if not memory.holds(at, data, start, end).all():
        return _encode_alone(column, path)  # two chunks of one hash
    count, first = memory.count[at].astype(np.int64), memory.start[at].astype(np.int64)
    ids, _ = _ranges(memory.ids, first, count)
    upto = np.cumsum(count)
    before = np.concatenate([[0], upto])[np.searchsorted(start, offsets)]
    return ids, np.diff(before)
