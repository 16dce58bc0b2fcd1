"""Removal of repeated word windows through difference-cover anchors.

A set of residues is a *difference cover* of a period when every difference
modulo the period occurs between two of them.  If two runs of ``window`` words
are equal, then for some shift below the period both hold, at that shift, a
place whose residue is in the cover.  So only windows of ``window - period + 1``
words at cover residues are hashed (5 of every 21 places), and every repeated
run still shares an anchor.

1. Each block of documents asks which of its anchor hashes occur elsewhere.
2. Around shared anchors only, matches are extended: all full windows that
   contain one are hashed (96 bits) and asked for.  Both sides of a repeat hold
   the shared anchor, so both ask, and a window asked for twice is a repeat.
3. The words under repeated windows are removed.

A window may repeat in its own document, overlapping itself.  All windows are
judged on the input.

Cases: a null text has no words, texts shorter than the window are kept whole,
repeated rows repeat each other's windows, a null ``doc_id`` is carried along,
an empty table gives no rows, further columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adevents.llm import blocks as B
from adevents.llm.common import as_table
from adevents.llm.words import Texts, Windows, covered

WINDOW = 35
PERIOD = 21
_ANCHOR_BITS = 48  # anchors only propose: a false one costs a few more windows
OUTPUT = "row_id long, doc_id long, n_words long, removed array<struct<start:int,end:int>>, kept_text string"


def difference_cover(period: int) -> tuple[int, ...]:
    """A smallest set of residues that has every difference modulo ``period``."""
    for size in range(1, period + 1):
        for rest in itertools.combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if size * (size - 1) + 1 >= period and len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError(f"no cover of {period}")


class _Places:
    """Where a block's anchors and windows may start."""

    def __init__(self, texts: Texts, window: int, period: int, cover: tuple[int, ...]):
        self.texts, self.window, self.period = texts, window, period
        self.size = window - period + 1
        wanted = np.zeros(period, bool)
        wanted[list(cover)] = True
        place = texts.place_in_text()
        left = np.repeat(texts.n_words, texts.n_words) - place
        self.fits = left >= window  # a full window starts here
        in_long = np.repeat(texts.n_words >= window, texts.n_words)
        self.anchors = np.flatnonzero(wanted[place % period] & (left >= self.size) & in_long)
        self.words = texts.hashes()

    def anchor_keys(self):
        """Distinct anchor hashes, which of them each anchor has, and which occur twice here."""
        keys = Windows(self.words).at(self.anchors, self.size) >> np.uint64(64 - _ANCHOR_BITS)
        keys, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
        return keys, which, counts > 1

    def around(self, shared: np.ndarray) -> np.ndarray:
        """Starts of the windows that contain one of the shared anchors at a shift below the period."""
        at = self.anchors[shared]
        first = self.texts.first[np.searchsorted(self.texts.first, at, "right") - 1]
        begin = np.maximum(at - (self.period - 1), first)
        return np.flatnonzero(covered(begin, at - begin + 1, len(self.words)) & self.fits)

    def window_keys(self, starts: np.ndarray):
        """As :meth:`anchor_keys`, for windows: 64-bit keys and 32 bits more."""
        high = Windows(self.words).at(starts, self.window)
        low = (Windows(self.words, second=True).at(starts, self.window) >> np.uint64(32)).astype(np.uint32)
        return _distinct(high, low)


def _distinct(high: np.ndarray, low: np.ndarray):
    order = np.argsort(high, kind="stable")
    h, w = high[order], low[order]
    same_high = h[1:] == h[:-1]
    if (same_high & (w[1:] != w[:-1])).any():  # equal in 64 bits only: sort by all 96
        order = np.lexsort((low, high))
        h, w = high[order], low[order]
        same_high = h[1:] == h[:-1]
    new = np.ones(len(h), bool)
    new[1:] = ~(same_high & (w[1:] == w[:-1]))
    which = np.empty(len(h), np.int64)
    which[order] = np.cumsum(new) - 1
    edges = np.flatnonzero(new)
    counts = np.diff(np.append(edges, len(h)))
    return h[edges], w[edges], which, counts > 1


def shared_bits(replies: list[bytes], n: int) -> np.ndarray:
    """The parts' answers, one bit per distinct key, as one array."""
    out = []
    for reply in replies:
        count, bits = B.unpack_arrays(reply)
        out.append(B.flags_of(bits, int(count[0])))
    found = np.concatenate(out) if out else np.zeros(0, bool)
    if len(found) != n:
        raise RuntimeError("the documents of a block changed between two rounds; write them to a table first")
    return found


def reply_shared(payloads: list[bytes]) -> list[bytes]:
    asked = [B.unpack_arrays(p) for p in payloads]
    keys = [B.ungap(d) for d, _ in asked]
    twice = [B.flags_of(bits, len(k)) for k, (_, bits) in zip(keys, asked)]
    _, which, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    return _bits_per_block(which, counts, keys, twice)


def _reply_windows(payloads: list[bytes]) -> list[bytes]:
    asked = [B.unpack_arrays(p) for p in payloads]
    keys = [B.ungap(a[0]) for a in asked]
    twice = [B.flags_of(a[2], len(k)) for k, a in zip(keys, asked)]
    _, _, which, _ = _distinct(np.concatenate(keys), np.concatenate([a[1] for a in asked]))
    return _bits_per_block(which, np.bincount(which), keys, twice)


def _bits_per_block(which, counts, keys, twice) -> list[bytes]:
    """A key is shared when two blocks ask for it or one holds it twice."""
    here = np.concatenate(twice)
    shared = counts > 1
    shared[which[here]] = True
    flags = shared[which]
    out, at = [], 0
    for k in keys:
        n = len(k)
        out.append(B.pack_arrays(np.array([n]), B.bits_of(flags[at : at + n])))
        at += n
    return out


def find_and_remove(docs: DataFrame, window: int = WINDOW, period: int = PERIOD) -> DataFrame:
    """One row per document (``OUTPUT``): removed runs of words and the kept text.

    ``docs`` has ``doc_id`` and ``text``.
    """
    docs = as_table(docs)
    if not 1 <= period <= window:
        raise ValueError("the period must be between 1 and the window")
    cover, layout = difference_cover(period), B.layout_of(docs)
    parts = layout.parts

    def places(rows: pa.Table) -> _Places:
        return _Places(Texts(rows.column("text")), window, period, cover)

    def ask_anchors(rows, _):
        keys, _, twice = places(rows).anchor_keys()
        cut = B.cuts_of(keys, parts, _ANCHOR_BITS)
        return [B.pack_arrays(B.gaps(keys[a:b]), B.bits_of(twice[a:b])) for a, b in zip(cut, cut[1:])]

    def candidates(p: _Places, replies: list[bytes]) -> np.ndarray:
        keys, which, _ = p.anchor_keys()
        return p.around(shared_bits(replies, len(keys))[which])

    def ask_windows(rows, earlier):
        p = places(rows)
        high, low, _, twice = p.window_keys(candidates(p, earlier[1]))
        cut = B.cuts_of(high, parts)
        return [B.pack_arrays(B.gaps(high[a:b]), low[a:b], B.bits_of(twice[a:b])) for a, b in zip(cut, cut[1:])]

    def remove(rows, earlier):
        p = places(rows)
        starts = candidates(p, earlier[1])
        high, _, which, _ = p.window_keys(starts)
        repeated = starts[shared_bits(earlier[2], len(high))[which]]
        gone = covered(repeated, window, len(p.words))
        return _result(rows, p.texts, gone)

    dealt = B.deal(docs, layout, "doc_id", "text")
    shared_anchors = B.answered(B.questions(dealt, 1, ask_anchors), reply_shared, layout)
    repeated = B.answered(B.questions(dealt, 2, ask_windows, shared_anchors), _reply_windows, layout)
    return B.finish(dealt, shared_anchors.unionByName(repeated), OUTPUT, remove)


def _result(rows: pa.Table, texts: Texts, gone: np.ndarray) -> pa.Table:
    kept = np.flatnonzero(~gone)
    text_of = texts.text_of_word()
    # Kept words and one separator after each but its text's last.
    last = np.ones(len(kept), bool)
    last[:-1] = text_of[kept[1:]] != text_of[kept[:-1]]
    edge = np.zeros(len(texts.data) + 1, np.int8)
    edge[texts.start[kept]] += 1
    edge[texts.end[kept]] -= 1  # where a text ends in a word, the next may start with one: net 0
    keep = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    data = texts.data.copy()
    between = texts.end[kept[~last]]
    keep[between] = True
    data[between] = 32
    before = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=before[1:])
    out = data[keep]
    kept_text = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(before[texts.offsets]), pa.py_buffer(out))
    # Removed runs of words, by text.
    edges = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
    cut = np.zeros(len(gone) + 1, bool)  # a run ends where a text does
    cut[texts.first[:-1]] = True
    inside = np.zeros(len(gone) + 1, bool)
    inside[1:-1] = gone[1:] & gone[:-1]
    begins = np.flatnonzero((edges == 1) | (cut & inside))
    ends = np.flatnonzero((edges == -1) | (cut & inside))
    owner = text_of[begins] if len(begins) else np.zeros(0, np.int64)
    base = texts.first[owner]
    runs = pa.StructArray.from_arrays(
        [pa.array(begins - base, pa.int32()), pa.array(ends - base, pa.int32())], names=["start", "end"]
    )
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    return pa.table(
        {
            "row_id": rows.column("row_id"),
            "doc_id": rows.column("doc_id").cast(pa.int64()),
            "n_words": pa.array(texts.n_words, pa.int64()),
            "removed": pa.ListArray.from_arrays(pa.array(bounds), runs),
            "kept_text": kept_text.cast(pa.string()),
        }
    )


def dedup_digest(docs: DataFrame) -> DataFrame:
    """Per document: its words, how many are removed, the sha256 of the kept text and the removed runs (``start-end,..``)."""
    runs = F.transform("removed", lambda r: F.concat_ws("-", r["start"].cast("string"), r["end"].cast("string")))
    size = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    return find_and_remove(docs).select(
        "doc_id", "n_words", size.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"), F.array_join(runs, ",").alias("removed")
    )
