"""Collocations: frequent phrases of 2 to 5 words that score high at every cut, per language.

First pass: Misra-Gries summaries.  The texts are dealt into blocks
(:mod:`adevents.llm.blocks`), and every n-gram of a language is hashed to one
key partition.  Each partition has a summary of at most ``mass // threshold``
counters, ``mass`` being the number of n-gram occurrences that the partition
gets; so ``(capacity + 1) * threshold > mass``.  A block's distinct n-grams with
their counts are a summary themselves; summaries are merged by adding their
counters and, where there are more than the capacity, taking the (capacity +
1)-th largest off all of them.  Each unit taken off is taken off capacity + 1
counters at once, so nothing loses more than ``mass / (capacity + 1)``, which is
below the threshold: every n-gram that occurs so often survives, whatever the
order of the merges.  The partition answers which of a block's n-grams did.

A phrase is no more frequent than the words and pairs in it, so there are three
rounds of summaries: of words, of pairs of words that survived, and of runs of
3 to 5 words whose pairs all did, which keeps most of the mass away.

Second pass: each partition adds up the survivors' counts from what the blocks
sent, by key, and drops those below the threshold.  These keys are hashes as
short as the texts allow, so they only propose.  Blocks then count the phrases
of the keys that are left, by numbers that equal words alone share, and send the
counts with 64 bits of an independent hash; the sums of these decide.  The first
block that holds a frequent phrase is told its total and writes it, so every
phrase is one row.  All parts of a candidate are at least as frequent, so the
same table has the counts of both sides of every cut.

Scores are ``floor(1000 * a * n / (l * r))`` in decimals of 38 digits, exact for
counts up to 10**16.  Each language's best rows are taken in two steps, from
hashed groups of its phrases and then from their best.

Cases: a null text is empty, a null ``lang`` is ``und``; repeated rows count
each; an empty table or one without frequent phrases gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adevents.llm import blocks as B
from adevents.llm.common import as_table, saved
from adevents.llm.words import Texts, Windows, distinct, mix, same_ranges

LONGEST = 5
THRESHOLD = 100
FIRST = 2000
NO_LANG = "und"
_GROUPS = 64
_SPARE_BITS = 11
_BYTES = np.arange(256)
#: A word is a run of bytes other than space, tab, the marks below and LF to CR; marks and LF to CR end a piece.
_BREAK = np.isin(_BYTES, [*b".,;:!?", *range(10, 14)])
_WORD = ~(_BREAK | (_BYTES == 32) | (_BYTES == 9))
PHRASES = "lang string, words int, phrase string, n long"


class Summary:
    """A mergeable Misra-Gries summary: distinct ascending keys and positive counts."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.keys = np.zeros(0, np.uint64)
        self.counts = np.zeros(0, np.int64)
        self.lost = 0  # no key lost more

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds another summary's counters (distinct keys)."""
        both, which = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        total = np.zeros(len(both), np.int64)
        np.add.at(total, which, np.concatenate([self.counts, counts]))
        if len(both) > self.capacity:
            place = len(total) - 1 - self.capacity
            cut = int(np.partition(total, place)[place])  # the (capacity + 1)-th largest
            self.lost += cut
            total -= cut
            stays = total > 0
            both, total = both[stays], total[stays]
        self.keys, self.counts = both, total


class Phrases:
    """A block's words, their pieces, and keys of its n-grams."""

    def __init__(self, rows: pa.Table):
        self.texts = texts = Texts(rows.column("text"), _WORD, lower=True)
        langs = rows.column("lang").to_pylist()
        self.names = sorted({NO_LANG if x is None else x for x in langs})
        number = {x: i for i, x in enumerate(self.names)}
        self.lang = np.array([number[NO_LANG if x is None else x] for x in langs], np.int64)[texts.text_of_word()]
        n = len(texts.start)
        # A word goes on with the one before it unless a text or a mark lies between.
        breaks = np.concatenate([[0], np.cumsum(_BREAK[texts.data])])
        goes_on = np.zeros(n, bool)
        if n > 1:
            goes_on[1:] = breaks[texts.start[1:]] == breaks[texts.end[:-1]]
        goes_on[texts.first[:-1][texts.n_words > 0]] = False
        begins = np.flatnonzero(~goes_on)
        piece = np.cumsum(~goes_on) - 1
        piece_end = np.append(begins[1:], n)
        self.left = piece_end[piece] - np.arange(n) if n else np.zeros(0, np.int64)  # words to the end of the piece
        tags = Texts(pa.array(self.names, pa.string()), np.ones(256, bool))
        tags.start, tags.end = tags.offsets[:-1], tags.offsets[1:]
        with np.errstate(over="ignore"):
            tag = mix(tags.hashes() + np.uint64(0x27D4EB2F165667C5)) if len(self.names) else np.zeros(0, np.uint64)
            self.words = mix(texts.hashes() ^ tag[self.lang])
            self._tag, self._second = tag, None
        self._windows = Windows(self.words)
        self._every_word = None
        self.often: dict[int, np.ndarray] = {}
        self.runs: dict[int, _Runs] = {}

    def starts(self, k: int, frequent: np.ndarray | None = None, width: int = 1) -> np.ndarray:
        """Where runs of ``k`` words of a piece begin; ``frequent`` tells from which places on all their runs of ``width`` words are."""
        at = np.flatnonzero(self.left >= k)
        if frequent is None:
            return at
        rare = np.concatenate([[0], np.cumsum(~frequent, dtype=np.int32)])
        return at[rare[at + k - width + 1] == rare[at]]

    def every_word(self) -> _Runs:
        if self._every_word is None:
            self._every_word = _Runs(np.arange(len(self.words)), self.words)
        return self._every_word

    def numbers(self) -> np.ndarray:
        """A number per word: equal for equal words of one language, and only for them."""
        t, runs = self.texts, self.every_word()
        which = runs.which
        first = runs.example[which]
        same = (t.end - t.start == t.end[first] - t.start[first]) & (self.lang == self.lang[first])
        if (same & same_ranges(t.data, t.start, t.end, t.data, t.start[first])).all():
            return which
        raw, seen = t.data.tobytes(), {}  # two words of one hash
        words = zip(self.lang.tolist(), t.start.tolist(), t.end.tolist())
        return np.array([seen.setdefault((x, raw[a:b]), len(seen)) for x, a, b in words], np.int64)

    def keys(self, at: np.ndarray, k: int, bits: int) -> np.ndarray:
        return (self.words[at] if k == 1 else self._windows.at(at, k)) >> np.uint64(64 - bits)

    def others(self, at: np.ndarray, k: int) -> np.ndarray:
        """64 bits of a second hash of runs."""
        if self._second is None:
            self._second = Windows(mix(self.texts.hashes(seed=1) ^ self._tag[self.lang]))
        return self._second.at(at, k)


class _Runs:
    """The distinct runs of one length among those at some places, by all 64 bits of their keys, found by one sort."""

    def __init__(self, at: np.ndarray, keys: np.ndarray):
        self.at = at
        self.keys, self.example, self.which = distinct(keys)

    def keep(self, replies: list[bytes], nth: int, bits: int) -> np.ndarray:
        """Which places' runs survived; runs that share the leading ``bits`` do so together."""
        short = self.keys >> np.uint64(64 - bits)
        new = np.ones(len(short), bool)
        np.not_equal(short[1:], short[:-1], out=new[1:])
        group = np.cumsum(new) - 1
        self.kept = _flags(replies, nth, int(group[-1]) + 1 if len(group) else 0)[group]
        return self.kept[self.which]


def _key_bits(layout: B.Layout) -> int:
    """Keys as short as leaves one n-gram in about a thousand that shares another's."""
    return min(64, max(1, layout.size).bit_length() + _SPARE_BITS)


def _cut(keys: np.ndarray, counts: np.ndarray, parts: int, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    cut = B.cuts_of(keys, parts, bits)
    small = counts.astype(np.min_scalar_type(int(counts.max()) if len(counts) else 0))
    return [(B.gaps(keys[a:b]), small[a:b]) for a, b in zip(cut, cut[1:])]


def _survivors(threshold: int):
    """A partition's summary over all blocks, and which of each block's keys are in it and frequent.

    A payload has a pair of arrays, keys and counts, for each of some lengths;
    each length has its own summary.
    """

    def reply(payloads: list[bytes]):
        mass: list[int] = []
        for p in payloads:
            sums = [int(c.sum(dtype=np.int64)) for c in B.unpack_arrays(p)[1::2]]
            mass = [a + b for a, b in zip(mass, sums)] if mass else sums
        summaries = [Summary(m // threshold) for m in mass]
        for i, summary in enumerate(summaries):
            pending, size = [], 0
            for p in payloads:  # a few blocks at a time, as many as the summary may hold again
                gaps, counts = B.unpack_arrays(p)[2 * i : 2 * i + 2]
                pending.append((B.ungap(gaps), counts.astype(np.int64)))
                size += len(gaps)
                if size > max(summary.capacity, 1 << 16):
                    _merge_all(summary, pending)
                    pending, size = [], 0
            _merge_all(summary, pending)
            total = np.zeros(len(summary.keys), np.int64)
            for p in payloads:  # the second pass
                gaps, counts = B.unpack_arrays(p)[2 * i : 2 * i + 2]
                at, found = _find(summary.keys, B.ungap(gaps))
                total[at[found]] += counts[found].astype(np.int64)
            summary.keys = summary.keys[total >= threshold]
        for p in payloads:
            arrays = B.unpack_arrays(p)
            held = []
            for summary, gaps in zip(summaries, arrays[::2]):
                _, found = _find(summary.keys, B.ungap(gaps))
                held += [np.array([len(found)]), B.bits_of(found)]
            yield B.pack_arrays(*held)

    return reply


def _find(held: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key is among the held ones, and whether it is."""
    at = np.searchsorted(held, keys)
    found = at < len(held)
    found[found] = held[at[found]] == keys[found]
    return at, found


def _merge_all(summary: Summary, pending: list) -> None:
    if pending:
        keys, which = np.unique(np.concatenate([k for k, _ in pending]), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, which, np.concatenate([c for _, c in pending]))
        summary.merge(keys, counts)


def _flags(replies: list[bytes], nth: int, n: int) -> np.ndarray:
    """Which of a block's ``n`` keys of the ``nth`` length survived."""
    parts = [B.unpack_arrays(r)[2 * nth : 2 * nth + 2] for r in replies]
    flags = np.concatenate([B.flags_of(bits, int(size[0])) for size, bits in parts])
    if len(flags) != n:
        raise RuntimeError("the documents of a block changed between two rounds; write them to a table first")
    return flags


def frequent_phrases(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """``lang, words, phrase, n``: exact counts of all phrases of up to 5 words that occur ``threshold`` times.

    Rows of no words add up to the number of all words of their language.
    """
    docs = as_table(docs)
    layout = B.layout_of(docs)
    bits = _key_bits(layout)
    dealt = B.deal(docs, layout, "lang", "text")

    def often(p: Phrases, earlier, width: int) -> np.ndarray | None:
        """From which places on the run of ``width`` (0 to 2) words survived."""
        if not width:
            return None
        if width in p.often:
            return p.often[width]
        out = p.often[width] = np.zeros(len(p.words), bool)
        if width == 1:
            runs = p.every_word()
        else:
            at = p.starts(width, often(p, earlier, width - 1), width - 1)
            runs = _Runs(at, p.keys(at, width, 64))
        p.runs[width] = runs
        out[runs.at] = runs.keep(earlier[width], 0, bits)
        return out

    def ask(lengths: range, width: int):
        def payloads(rows, earlier):
            p = Phrases(rows)
            frequent = often(p, earlier, width)
            parts: list[list[np.ndarray]] = [[] for _ in range(layout.parts)]
            for k in lengths:
                keys, counts = np.unique(p.keys(p.starts(k, frequent, width), k, bits), return_counts=True)
                for part, pair in zip(parts, _cut(keys, counts, layout.parts, bits)):
                    part += pair
            return [B.pack_arrays(*part) for part in parts]

        return payloads

    def survivors(p: Phrases, earlier) -> _Entries:
        pairs = often(p, earlier, 2)
        for k in range(3, LONGEST + 1):
            starts = p.starts(k, pairs, 2)
            p.runs[k] = _Runs(starts, p.keys(starts, k, 64))
            p.runs[k].keep(earlier[3], k - 3, bits)
        return _Entries(p, bits)

    def ask_counts(rows, earlier):
        p = Phrases(rows)
        e = survivors(p, earlier)
        others = e.others(p)
        cut = B.cuts_of(e.keys, layout.parts, bits)
        small = e.counts.astype(np.min_scalar_type(int(e.counts.max()) if len(e.counts) else 0))
        return [B.pack_arrays(B.gaps(e.keys[a:b]), others[a:b], small[a:b]) for a, b in zip(cut, cut[1:])]

    def phrases(rows, earlier) -> pa.Table:
        p = Phrases(rows)
        e = survivors(p, earlier)
        parts = [B.unpack_arrays(r) for r in earlier[4]]
        mine = np.concatenate([B.flags_of(flags, int(size[0])) for size, flags, _ in parts])
        if len(mine) != len(e.keys):
            raise RuntimeError("the documents of a block changed between two rounds; write them to a table first")
        total = np.concatenate([x for *_, x in parts])
        return pa.concat_tables([_by_text(p, e.example[mine], e.words[mine], total), _totals(p)])

    answers = B.answered(B.questions(dealt, 1, ask(range(1, 2), 0)), _survivors(threshold), layout)
    for number, lengths in ((2, range(2, 3)), (3, range(3, LONGEST + 1))):
        more = B.questions(dealt, number, ask(lengths, number - 1), answers)
        answers = answers.unionByName(B.answered(more, _survivors(threshold), layout))
    exact = B.answered(B.questions(dealt, 4, ask_counts, answers), _add_up(threshold), layout)
    return B.finish(dealt, answers.unionByName(exact), PHRASES, phrases)


class _Entries:
    """A block's distinct phrases among the runs that survived, by ascending key: counts, lengths, and a place of each."""

    def __init__(self, p: Phrases, bits: int):
        numbers = p.numbers()
        found = []
        for k in range(1, LONGEST + 1):
            runs = p.runs[k]
            held, kept = np.flatnonzero(runs.kept), runs.kept[runs.which]
            starts, first = runs.at[kept], runs.at[runs.example[runs.which[kept]]]
            if all((numbers[starts + i] == numbers[first + i]).all() for i in range(k)):
                place = runs.at[runs.example[held]]
                counts = np.bincount(runs.which, minlength=len(runs.keys))[held]
                keys = runs.keys[held] >> np.uint64(64 - bits)
            else:  # two phrases of one hash
                run = numbers[starts]
                for i in range(1, k):
                    run = np.unique(run * np.int64(len(numbers)) + numbers[starts + i], return_inverse=True)[1]
                _, example, counts = np.unique(run, return_index=True, return_counts=True)
                place = starts[example]
                keys = p.keys(place, k, bits)
            found.append((keys, counts, np.full(len(place), k), place))
        keys, counts, words, example = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(keys, kind="stable")
        self.keys, self.counts, self.words, self.example = keys[order], counts[order], words[order], example[order]

    def others(self, p: Phrases) -> np.ndarray:
        """The second keys."""
        out = np.empty(len(self.keys), np.uint64)
        for k in range(1, LONGEST + 1):
            chosen = np.flatnonzero(self.words == k)
            out[chosen] = p.others(self.example[chosen], k)
        return out


def _add_up(threshold: int):
    """The total of each phrase, told to the first block that holds it, where it is frequent."""

    def reply(payloads: list[bytes]):
        asked = [B.unpack_arrays(p) for p in payloads]
        sizes = [len(a[0]) for a in asked]
        keys = np.concatenate([B.ungap(a[0]) for a in asked])
        others = np.concatenate([a[1] for a in asked])
        counts = np.concatenate([a[2].astype(np.int64) for a in asked])
        order = np.lexsort((others, keys))  # stable: blocks in order
        edges = np.flatnonzero(np.r_[True, (keys[order][1:] != keys[order][:-1]) | (others[order][1:] != others[order][:-1])][: len(order)])
        total = np.zeros(len(keys), np.int64)
        if len(edges):
            total[order[edges]] = np.add.reduceat(counts[order], edges)
        first = 0
        for n in sizes:
            own = total[first : first + n]
            yield B.pack_arrays(np.array([n]), B.bits_of(own >= threshold), own[own >= threshold])
            first += n

    return reply


def _by_text(p: Phrases, first: np.ndarray, size: np.ndarray, total: np.ndarray) -> pa.Table:
    """Rows of the runs of ``size`` words from ``first`` on, words joined by one space."""
    raw = p.texts.data.tobytes()
    nth = np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)
    words = [raw[a:b] for a, b in zip(p.texts.start[nth].tolist(), p.texts.end[nth].tolist())]
    upto = np.cumsum(size).tolist()
    phrases = [b" ".join(words[b - k : b]).decode("utf-8") for b, k in zip(upto, size.tolist())]
    langs = pa.array(p.names, pa.string()).take(pa.array(p.lang[first] if len(first) else np.zeros(0, np.int64)))
    return pa.table(
        {"lang": langs, "words": pa.array(size, pa.int32()), "phrase": pa.array(phrases, pa.string()), "n": pa.array(total, pa.int64())}
    )


def _totals(p: Phrases) -> pa.Table:
    """A row with no phrase per language: all its words."""
    n = np.bincount(p.lang, minlength=len(p.names))
    return pa.table(
        {
            "lang": pa.array(p.names, pa.string()),
            "words": pa.array([0] * len(n), pa.int32()),
            "phrase": pa.array([""] * len(n), pa.string()),
            "n": pa.array(n, pa.int64()),
        }
    )


def _scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut: ``lang, words, phrase, a, l, r, n, score``."""
    parts = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = (
        phrases.where("words > 1")
        .select("lang", "words", "phrase", F.col("n").alias("a"), parts.alias("w"), cut)
        .select(
            "lang", "words", "phrase", "a", "k",
            F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
            F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("tail"),
        )
    )
    of = lambda name, n: phrases.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    score = F.expr(
        "(cast(1000 * cast(a AS decimal(17,0)) AS decimal(20,0)) * cast(n AS decimal(17,0)))"
        " div (cast(l AS decimal(17,0)) * cast(r AS decimal(17,0)))"
    )
    rows = (
        cuts.join(of("head", "l"), ["lang", "head"])
        .join(of("tail", "r"), ["lang", "tail"])
        .join(totals.withColumnRenamed("total", "n"), "lang")
        .withColumn("score", score)
    )
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return rows.groupBy("lang", "words", "phrase", "a", "n").agg(best).select(
        "lang", "words", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score")
    )


def _inside_longer(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, longer``: the highest count of a longer candidate that holds the phrase's words in a row."""
    w = F.split("phrase", " ")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda k: F.transform(
                F.sequence(F.lit(1), F.col("words") - k + 1), lambda i: F.array_join(F.slice(F.col("w"), i, k), " ")
            ),
        )
    )
    return (
        phrases.where("words > 2")
        .withColumn("w", w)
        .select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "n")
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("longer"))
    )


def collocations(docs: DataFrame, threshold: int = THRESHOLD, first: int = FIRST) -> DataFrame:
    """Each language's best phrases: ``lang, rank, phrase, a, l, r, n, score``."""
    found = saved(frequent_phrases(docs, threshold), "phrases")
    totals = found.where("words = 0").groupBy("lang").agg(F.sum("n").alias("total"))  # one row per language
    phrases = found.where("words > 0")
    kept = (
        _scored(phrases, totals)
        .join(_inside_longer(phrases), ["lang", "phrase"], "left")
        .where(F.col("longer").isNull() | (100 * F.col("longer") < 100 * F.col("a")))
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # The best of each hashed group of a language's phrases, then the best of those.
    group = F.pmod(F.xxhash64("phrase"), F.lit(_GROUPS))
    near = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", group).orderBy(*order))).where(F.col("rank") <= first)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return near.withColumn("rank", rank).where(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
