"""A Katz backoff language model over word n-grams, fitted and evaluated by hash partitions.

The probability of a token after a context of ``order - 1`` tokens is

* ``d(c) * c / c(context)`` where the n-gram was counted ``c >= min_count``
  times in the training documents, with Good-Turing's discount ``d`` up to
  counts of ``CUTOFF``, and else
* ``alpha(context)`` times the probability at the next lower order, with
  ``alpha`` such that the probabilities of all tokens after the context sum
  to 1 exactly; it is 1 after contexts without n-grams in the table.

Unigrams are discounted alike; what that leaves is the probability of the one
class of unknown words.  A context whose n-grams would leave nothing keeps the
share ``0.5 / (c(context) + 0.5)`` for backing off, and its n-grams' shares are
scaled to the rest.

Documents are dealt into blocks (:mod:`adevents.llm.blocks`), which first put their
distinct words to hash partitions of the words and get each one's count and number
back (frequent words of a partition have small numbers).  Then every token is sent
once, with its document and the numbers of the ``order - 1`` words before it, to the
partition of the word before it: that one has all contexts that end in this word and
so counts the n-grams of every order.  Tokens after a *common* word (one with more
than half of what a partition holds on average; the beginning of texts counts as one)
are dealt by the word before that too.  Their contexts of two and more words are still
whole in one partition; bigrams after common words are added up by hash partitions of
the pairs, whose answers also bring the counts of counts of the whole corpus.
With these a partition has the probability of each of its tokens, and answers
with one sum per document.

So the model is a table partitioned by the last word of the context (``write_model``
stores it), and the tokens of a text are evaluated where their n-grams are.

Cases: a null text has the end token alone, a null ``doc_id`` counts as the
empty text in the split, repeated rows are counted and scored each, without
training documents every token is unknown, an empty table gives no rows,
further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adevents.llm import blocks as B
from adevents.llm.common import as_table, remainder_of
from adevents.llm.words import Texts, distinct, mix
from adevents.session import scratch_path

ORDER = 2
MIN_COUNT = 2
#: The registered query's model: trigrams, with all n-grams that were counted.
QUERY_ORDER = 3
QUERY_MIN_COUNT = 1
CUTOFF = 5
#: Most frequent words of a partition that it names to all blocks.
_NAMED = 16
#: The number of the beginning of a text; words have numbers from 1 on.
_BEGIN = 0
_END = np.uint64(0x1D8E4E27C47D124F)
SCORES = "row_id long, doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def discounts(n: np.ndarray) -> np.ndarray:
    """Good-Turing factors for the counts 0..CUTOFF from the counts of counts ``n[r]``, ``r`` up to CUTOFF + 1.

    Where the counts of counts give no factor between 0 and 1, it is ``(r - 0.5) / r``.
    """
    out = np.ones(CUTOFF + 1)
    shared = (CUTOFF + 1) * n[CUTOFF + 1] / n[1] if n[1] else 1.0
    for r in range(1, CUTOFF + 1):
        turing = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        d = (turing - shared) / (1 - shared) if shared != 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(counts <= CUTOFF, d[np.minimum(counts, CUTOFF)], 1.0) * counts


class Tokens:
    """A block's tokens: hashes, and each one's document and place in it."""

    def __init__(self, rows: pa.Table):
        texts = Texts(rows.column("text"), lower=True)
        n = texts.n_words
        self.first = texts.first + np.arange(len(texts) + 1)
        self.hashes = np.full(int(self.first[-1]), _END)
        self.hashes[np.arange(len(texts.start)) + texts.text_of_word()] = texts.hashes()
        self.document = np.repeat(np.arange(len(texts)), n + 1)
        self.train = rows.column("train").to_numpy(zero_copy_only=False).astype(bool)
        self.keys, _, self.which = distinct(self.hashes)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """How often each distinct token occurs in training documents, and in the others."""
        every = np.bincount(self.which, minlength=len(self.keys))
        train = np.bincount(self.which, weights=self.train[self.document], minlength=len(self.keys))
        return train.astype(np.uint32), (every - train).astype(np.uint32)

    def before(self, numbers: np.ndarray, back: int) -> np.ndarray:
        """The number of the word ``back`` places before each token."""
        out = np.full(len(numbers), _BEGIN, np.int64)
        has = np.flatnonzero(np.arange(len(numbers)) - self.first[self.document] >= back)
        out[has] = numbers[has - back]
        return out


def _histogram(totals: np.ndarray) -> np.ndarray:
    """How many totals are 0, 1, .. CUTOFF + 1."""
    return np.bincount(totals[totals <= CUTOFF + 1], minlength=CUTOFF + 2)


def _split(flat: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    return np.split(flat, np.cumsum(sizes)[:-1])


# ---- words ---------------------------------------------------------------------


def _ask_words(parts: int):
    def ask(rows, _):
        tokens = Tokens(rows)
        train, other = tokens.counts()
        cut = B.cuts_of(tokens.keys, parts)
        return [B.pack_arrays(B.gaps(tokens.keys[a:b]), train[a:b], other[a:b]) for a, b in zip(cut, cut[1:])]

    return ask


def _added_words(payloads):
    """A part's words by falling count, their counts in training and in all; which of them each asked word is."""
    asked = [B.unpack_arrays(p) for p in payloads]
    keys = [B.ungap(a[0]) for a in asked]
    found, _, which = distinct(np.concatenate(keys))
    train, other = (np.bincount(which, weights=np.concatenate([a[i] for a in asked]), minlength=len(found)).astype(np.int64) for i in (1, 2))
    order = np.argsort(-train, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return found[order], train[order], (train + other)[order], rank[which], [len(k) for k in keys]


def _reply_words(payloads):
    _, train, every, which, sizes = _added_words(payloads)
    head = np.array([train.sum(), (train > 0).sum(), *_histogram(train), every.sum()], np.int64)
    named = np.argsort(-every, kind="stable")[:_NAMED]
    counts = _split(train[which].astype(np.uint32), sizes)
    return [B.pack_arrays(head, named, every[named], r.astype(np.uint32), c) for r, c in zip(_split(which, sizes), counts)]


class Words:
    """What a block knows of its tokens: each one's number and training count, and which numbers are common."""

    def __init__(self, tokens: Tokens, replies: list[bytes]):
        answers = [B.unpack_arrays(r) for r in replies]
        parts, sizes = len(answers), [len(a[3]) for a in answers]
        if sum(sizes) != len(tokens.keys):
            raise RuntimeError("the documents of a block changed between two rounds; write them to a table first")
        self.head = sum(a[0] for a in answers)
        home = np.repeat(np.arange(parts), sizes)
        self.numbers = _number(np.concatenate([a[3] for a in answers]), home, parts)[tokens.which]
        self.counts = np.concatenate([a[4] for a in answers])[tokens.which].astype(np.int64)
        named = np.concatenate([_number(a[1], p, parts) for p, a in enumerate(answers)])
        often = np.concatenate([a[2] for a in answers]) * 2 * parts > self.head[-1]
        self.common = np.append(named[often], _BEGIN)


def _number(rank: np.ndarray, home, parts: int) -> np.ndarray:
    """The number of a word from its place in its part."""
    return rank.astype(np.int64) * parts + home + 1


def _single(head: np.ndarray):
    """The probability of a single token, as a function of its training count, from the sums over all parts."""
    total, words, n = int(head[0]), int(head[1]), head[2:-1]
    d = discounts(n)
    r = np.arange(CUTOFF + 1)
    left = float(((1 - d) * r * n[: CUTOFF + 1]).sum() / total) if total else 1.0
    unknown = max(left, 0.5 / (total + 0.5 * (words + 1)))
    scale = (1 - unknown) / (1 - left) / total if left < 1 else 0.0
    return lambda counts: np.where(counts > 0, discounted(counts, d) * scale, unknown)


# ---- tokens with their contexts --------------------------------------------------


def _base(rows: pa.Table, tokens: Tokens, words: Words) -> list[np.ndarray]:
    """The columns of a block's result that single tokens give."""
    total, distinct_words = int(words.head[0]), int(words.head[1])
    logs = np.log10((words.counts + 0.5) / (total + 0.5 * (distinct_words + 1)))
    doc_id = rows.column("doc_id").cast(pa.int64()).combine_chunks()
    return [
        rows.column("row_id").to_numpy().astype(np.int64),
        doc_id.fill_null(0).to_numpy(zero_copy_only=False),
        doc_id.is_null().to_numpy(zero_copy_only=False),
        np.diff(tokens.first),
        np.bincount(tokens.document, weights=words.counts > 0, minlength=len(tokens.first) - 1).astype(np.int64),
        np.full(rows.num_rows, total),
        np.add.reduceat(logs, tokens.first[:-1]),
    ]


def _ask_tokens(order: int, parts: int):
    """Every token once, in the order of the texts, to the part of the word before it."""

    def ask(rows, earlier):
        tokens = Tokens(rows)
        words = Words(tokens, earlier[_WORDS])
        last, *further = (tokens.before(words.numbers, back) for back in range(1, order))
        common = np.isin(last, words.common)
        part, code = (last - 1) % parts, (last - 1) // parts * 2
        dealt = (further[0] if further else words.numbers)[common].astype(np.uint64)
        with np.errstate(over="ignore"):
            part[common] = (mix(mix(last[common].astype(np.uint64)) + dealt) % np.uint64(parts)).astype(np.int64)
        code[common] = last[common] * 2 + 1
        base = _base(rows, tokens, words)
        base_part = int(base[0][0]) % parts
        by_part = np.argsort(part, kind="stable")
        cut = np.searchsorted(part[by_part], np.arange(parts + 1))
        out = []
        for p, (a, b) in enumerate(zip(cut, cut[1:])):
            at = by_part[a:b]
            per_document = np.bincount(tokens.document[at], minlength=rows.num_rows).astype(np.uint32)
            number = words.numbers[at]
            _, example = np.unique(number, return_index=True)
            out.append(
                B.pack_arrays(
                    words.head, B.bits_of(tokens.train), per_document, code[at], number, words.counts[at][example],
                    *(x[at] for x in further), *(base if p == base_part else ()),
                )
            )
        return out

    return ask


class Part:
    """All tokens of a part: numbers and counts of their words, and their contexts' words, the last first."""

    def __init__(self, messages: pa.Table, order: int, parts: int):
        messages = messages.sort_by("block")
        self.blocks = messages.column("block").to_pylist()
        part = messages.column("part")[0].as_py()
        asked = [B.unpack_arrays(p) for p in messages.column("payload").to_pylist()]
        self.single = _single(asked[0][0])
        self.head = asked[0][0]
        self.sizes = [len(a[2]) for a in asked]
        train = np.concatenate([B.flags_of(a[1], len(a[2])) for a in asked])
        self.document = np.repeat(np.arange(len(train)), np.concatenate([a[2] for a in asked]))
        self.train = train[self.document].astype(np.float64)
        code = np.concatenate([a[3] for a in asked])
        self.common = (code & 1).astype(bool)
        last = np.where(self.common, code >> 1, (code >> 1) * parts + part + 1)
        self.number = np.concatenate([a[4] for a in asked])
        counts = [a[5][np.unique(a[4], return_inverse=True)[1]] for a in asked]
        self.counts = np.concatenate(counts)
        self.history = [last] + [np.concatenate([a[6 + k] for a in asked]) for k in range(order - 2)]
        self.base = [a[6 + order - 2 :] for a in asked]
        self._numbers = 1 + max(int(x.max(initial=0)) for x in (self.number, *self.history))
        self.contexts = np.zeros(len(self.number), np.int64)
        self._further = iter(self.history)

    def next_order(self):
        """Goes on to contexts of one more word: their number, and an example, each token's and the training count of n-grams."""
        found, _, self.contexts = distinct(self.contexts * self._numbers + next(self._further))
        _, example, which = distinct(self.contexts * self._numbers + self.number)
        return len(found), example, which, np.bincount(which, weights=self.train, minlength=len(example)).astype(np.int64)

    def bigrams_after_common(self, example: np.ndarray, parts: int):
        """Which bigrams other parts may have too, by home, pair; their words; where each home's begin."""
        chosen = np.flatnonzero(self.common[example])
        last, number = self.history[0][example[chosen]], self.number[example[chosen]]
        with np.errstate(over="ignore"):
            home = mix(mix(last.astype(np.uint64)) ^ number.astype(np.uint64)) % np.uint64(parts)
        order = np.lexsort((number, last, home))
        return chosen[order], last[order], number[order], np.searchsorted(home[order], np.arange(parts + 1, dtype=np.uint64))


def _sums(of: np.ndarray, totals: np.ndarray, lower: np.ndarray, n: int, min_count: int) -> list[np.ndarray]:
    """Sums over the n-grams of each of ``n`` contexts: kept ones by count, and counts and lower-order probabilities."""
    kept = totals >= min_count
    by_count = [np.bincount(of[kept & (totals == r)], minlength=n) for r in range(1, CUTOFF + 1)]
    large = kept & (totals > CUTOFF)
    seen = np.bincount(of, weights=totals, minlength=n).astype(np.int64)
    above = np.bincount(of[large], weights=totals[large], minlength=n).astype(np.int64)
    return [seen, *by_count, above, np.bincount(of[kept], weights=lower[kept], minlength=n)]


def _ask_common(order: int, parts: int):
    """A part's bigrams after common words, to the homes of the pairs, and its counts of counts of all others."""

    def of_part(key, messages):
        part, number = Part(messages, order, parts), key[0].as_py()
        heads = np.zeros((order - 1, CUTOFF + 2), np.int64)
        out = []
        for k in range(order - 1):
            _, example, _, totals = part.next_order()
            if k == 0:
                chosen, last, word, cut = part.bigrams_after_common(example, parts)
                shared = totals[chosen].astype(np.uint32), part.counts[example[chosen]].astype(np.uint32)
                totals = totals[~part.common[example]]
            heads[k] = _histogram(totals)
        for home, (a, b) in enumerate(zip(cut, cut[1:])):
            own = heads if home == number else np.zeros_like(heads)
            out.append(B.pack_arrays(part.head, own.reshape(-1), B.gaps(last[a:b]), B.gaps(word[a:b]), *(x[a:b] for x in shared)))
        return B.answer_table(number, _COMMON, list(range(parts)), out)

    return of_part


def _added_bigrams(payloads):
    """A home's bigrams: the common words, which of them each bigram is after, an example, its total, and each asked one's number."""
    asked = [B.unpack_arrays(p) for p in payloads]
    last, word = (np.concatenate([B.ungap(a[i]) for a in asked]) for i in (2, 3))
    common, _, after = distinct(last)
    _, example, which = distinct(after * (1 + int(word.max(initial=0))) + word)
    totals = np.bincount(which, weights=np.concatenate([a[4] for a in asked]), minlength=len(example)).astype(np.int64)
    return asked, common, after[example], word[example], totals, example, which


def _reply_common(min_count: int):
    def reply(payloads):
        asked, common, after, _, totals, example, which = _added_bigrams(payloads)
        heads = sum(a[1] for a in asked)
        heads[: CUTOFF + 2] += _histogram(totals)
        lower = _single(asked[0][0])(np.concatenate([a[5] for a in asked])[example].astype(np.int64))
        sums = _sums(after, totals, lower, len(common), min_count)
        found = _split(totals[which].astype(np.uint32), [len(a[4]) for a in asked])
        return [B.pack_arrays(heads, common, *sums, x) for x in found]

    return reply


def backoff(seen, by_count, above, below, d):
    """``alpha`` of contexts, and the factor of their n-grams' shares (1 but where nothing would be left)."""
    taken = above.astype(np.float64)
    for r, n in enumerate(by_count, 1):
        taken += d[r] * r * n
    some = (taken > 0) & (seen > 0)
    share = np.divide(taken, seen, out=np.zeros(len(taken)), where=some)
    left = np.maximum(1 - share, 0.5 / (seen + 0.5))
    factor = np.divide(1 - left, share, out=np.ones(len(taken)), where=some)
    return np.where(some, left / (1 - below), 1.0), factor


def _evaluated(part: Part, replies: list[bytes], order: int, parts: int, min_count: int) -> np.ndarray:
    """The model's probability of each token of a part."""
    answers = [B.unpack_arrays(r) for r in replies]
    heads = sum(a[0] for a in answers).reshape(-1, CUTOFF + 2)
    probability = part.single(part.counts)
    for k in range(order - 1):
        n, example, which, totals = part.next_order()
        sums = _sums(part.contexts[example], totals, probability[example], n, min_count)
        if k == 0:
            chosen, _, _, cut = part.bigrams_after_common(example, parts)
            if [len(a[-1]) for a in answers] != np.diff(cut).tolist():
                raise RuntimeError("the documents of a block changed between two rounds; write them to a table first")
            totals[chosen] = np.concatenate([a[-1] for a in answers])
            # sums over all bigrams after common words, from all homes
            after = np.zeros(n, np.int64)
            after[part.contexts] = part.history[0]
            is_common = np.zeros(n, bool)
            is_common[part.contexts] = part.common
            for i, own in enumerate(sums, 2):
                own[is_common] = 0
            for a in answers:
                at = np.searchsorted(after, a[1])  # contexts are numbered by their word here
                here = at < n
                here[here] = after[at[here]] == a[1][here]
                for i, own in enumerate(sums, 2):
                    own[at[here]] += a[i][here]
        seen, *by_count, above, below = sums
        d = discounts(heads[k])
        alpha, factor = backoff(seen, by_count, above, below, d)
        of, count = part.contexts, totals[which]
        own = np.divide(discounted(count, d) * factor[of], seen[of], out=np.zeros(len(count)), where=seen[of] > 0)
        probability = np.where(count >= min_count, own, alpha[of] * probability)
    return probability


def _score_part(order: int, parts: int, min_count: int):
    """The sums of each block's documents over the tokens of a part, and the block's other columns where they came along."""

    def of_part(key, messages, replies):
        part = Part(messages, max(order, 2), parts)
        logs = np.log10(_evaluated(part, B.by_round(replies)[_COMMON], order, parts, min_count))
        sums = _split(np.bincount(part.document, weights=logs, minlength=sum(part.sizes)), part.sizes)
        payloads = [B.pack_arrays(x, *base) for x, base in zip(sums, part.base)]
        return B.answer_table(pa.array(part.blocks, pa.int32()), _SCORES, [key[0].as_py()] * len(payloads), payloads)

    return of_part


def _whole(rows):
    """A block's result from the parts' sums."""
    score, base = 0.0, None
    for payload in rows.sort_by("part").column("payload").to_pylist():
        sums, *more = B.unpack_arrays(payload)
        score, base = score + sums, more or base
    row_id, doc_id, without, *columns = base
    names = ["row_id", "doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return pa.table([pa.array(row_id), pa.array(doc_id, mask=without), *(pa.array(x) for x in (*columns, score))], names=names)


# ---- fitting and scoring -------------------------------------------------------

_WORDS, _TOKENS, _COMMON, _SCORES = 1, 2, 3, 4


def _layout(docs: DataFrame) -> B.Layout:
    """More and smaller parts than usual, as a part sorts all its tokens, and two blocks per part."""
    layout = B.layout_of(docs)
    parts = layout.parts * 3 // 2
    return B.Layout(2 * parts, parts, layout.size)


def _asked(docs: DataFrame, order: int, layout: B.Layout) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The blocks' words, their tokens by part, and the parts' bigrams after common words."""
    dealt = B.deal(docs, layout, "doc_id", "text", "train")
    words = B.questions(dealt, _WORDS, _ask_words(layout.parts))
    numbered = B.answered(words, _reply_words, layout)
    tokens = B.questions(dealt, _TOKENS, _ask_tokens(order, layout.parts), numbered).repartition(layout.parts, "part")
    return words, tokens, tokens.groupBy("part").applyInArrow(_ask_common(order, layout.parts), B.ANSWER)


def score_documents(docs: DataFrame, order: int = ORDER, train: str = "train", min_count: int = MIN_COUNT) -> DataFrame:
    """Scores of all rows of ``docs(doc_id, text, train)``; the model is learned from the rows with ``train``."""
    docs = as_table(docs)
    layout = _layout(docs)
    _, tokens, common = _asked(docs.withColumnRenamed(train, "train"), max(order, 2), layout)
    replies = B.answered(common, _reply_common(min_count), layout)
    scored = tokens.groupBy("part").cogroup(replies.groupBy("block")).applyInArrow(_score_part(order, layout.parts, min_count), B.ANSWER)
    return scored.groupBy("block").applyInArrow(_whole, SCORES)


def write_model(docs: DataFrame, path: str | None = None, order: int = ORDER, min_count: int = MIN_COUNT) -> str:
    """Writes the model of ``docs(text, train)`` as a table ``part, payload, order`` partitioned by order.

    It has the n-grams that are kept: a column of numbers for each word of the context, the last first,
    the words' numbers and the counts.  A second table, ``<path>_words``, has of each part the words'
    hashes and training counts; a word's number is its place there times the parts, plus the part, plus 1.
    """
    spark: SparkSession = docs.sparkSession
    docs = as_table(docs).withColumn("doc_id", F.lit(0))
    layout = _layout(docs)
    words, tokens, common = _asked(docs, max(order, 2), layout)
    path = path or scratch_path(spark, "katz")

    def table(key, tables):
        rows = [{"part": key[0].as_py(), "payload": B.pack_arrays(*arrays), "order": k} for k, arrays in tables.items()]
        return pa.Table.from_pylist(rows, pa.schema([("part", pa.int32()), ("payload", pa.binary()), ("order", pa.int32())]))

    def of_words(key, rows):
        hashes, counts, *_ = _added_words(rows.sort_by("block").column("payload").to_pylist())
        return table(key, {1: [hashes, counts]})

    def of_tokens(key, messages):
        part, out = Part(messages, max(order, 2), layout.parts), {}
        for k in range(order - 1):
            _, example, _, totals = part.next_order()
            kept = totals >= min_count
            if k == 0:
                kept &= ~part.common[example]
            at = example[kept]
            out[k + 2] = [*(x[at] for x in part.history[: k + 1]), part.number[at], totals[kept]]
        return table(key, out)

    def of_common(key, rows):
        _, common, after, word, totals, _, _ = _added_bigrams(rows.sort_by("block").column("payload").to_pylist())
        kept = totals >= min_count
        return table(key, {2: [common[after[kept]], word[kept], totals[kept]]} if order > 1 else {})

    tables = "part int, payload binary, order int"
    words.groupBy("part").applyInArrow(of_words, tables).write.parquet(f"{path}_words")
    for asked, of in ((tokens, of_tokens), (common, of_common)):
        asked.groupBy("part").applyInArrow(of, tables).write.mode("append").partitionBy("order").parquet(path)
    return path


def lm_digest(docs: DataFrame) -> DataFrame:
    held_out = remainder_of(F.col("doc_id")) == 1
    rows = docs.select("doc_id", "text", (~held_out).alias("train"))
    return score_documents(rows, QUERY_ORDER, min_count=QUERY_MIN_COUNT).select(
        "doc_id", (remainder_of(F.col("doc_id")) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
