"""Toxicity scores of whole texts by a recurrent network over all overlapping windows.

A text's words (ASCII letters lower-cased) are cut into windows of ``WINDOW``
words that start every ``STRIDE`` words, the last one ending with the text, so a
run of up to half a window's words is whole in some window; the network (:mod:`adevents.llm.gru`) scores every window, and a text's score is its
highest window's.

The network is trained on the driver from a bounded sample: at most
``MAX_POSITIVE`` and ``MAX_NEGATIVE`` labelled documents of at most
``MAX_CHARS`` characters, drawn by a hash of their id from the training split;
of rows with one id, the smallest text counts.
A label belongs to a document, not to a window; so the log-odds of the sample's
words choose each document's most telling window, and documents without the
label add random windows too.

Cases: a text without words gets the share of positives in the sample (below
0.5), and so does every text when the sample lacks one of the classes; a null ``doc_id`` is
scored; several labels of one id count as their maximum; null labels don't
count; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adevents.llm import gru
from adevents.llm.common import remainder_of
from adevents.llm.contamination import _slices as slices_of
from adevents.llm.words import ALNUM, Texts

WINDOW = 64
STRIDE = 32
MAX_POSITIVE = 1200
MAX_NEGATIVE = 3600
MAX_CHARS = 50_000
EPOCHS = 5
BATCH = 128
SEED = 11
_SMOOTHING = 12.0


class Windows:
    """A batch of texts as numbered words and window starts."""

    def __init__(self, column):
        self.texts = texts = Texts(column, ALNUM, lower=True)
        keys, example, self.number = np.unique(texts.hashes(), return_index=True, return_inverse=True)
        raw = texts.data.tobytes()
        words = [raw[a:b].decode("utf-8", "replace") for a, b in zip(texts.start[example].tolist(), texts.end[example].tolist())]
        self.vocabulary = gru.vocabulary(words, keys)
        n = texts.n_words
        count = np.where(n > WINDOW, -(-(n - WINDOW) // STRIDE) + 1, np.minimum(n, 1))
        self.text = np.repeat(np.arange(len(n)), count)
        nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        offset = np.minimum(nth * STRIDE, np.maximum(n[self.text] - WINDOW, 0))
        self.start = texts.first[self.text] + offset
        self.size = np.minimum(n[self.text], WINDOW)

    def grid(self, chosen: np.ndarray, places: int):
        """``(places, windows)`` word numbers and flags of the chosen windows."""
        at = self.start[chosen] + np.arange(places)[:, None]
        mask = np.arange(places)[:, None] < self.size[chosen]
        return self.number[np.minimum(at, len(self.number) - 1)], mask


def _log_odds(parts, label: np.ndarray, buckets: int) -> np.ndarray:
    """Smoothed log-odds of the label in the documents that hold a bucket, against all documents.

    ``parts`` gives ``(buckets, documents)``, all of a document's in one part.
    """
    yes, no = np.zeros(buckets), np.zeros(buckets)
    for bucket, document in parts:
        pairs = np.unique(bucket * len(label) + document)
        bucket, of = pairs // len(label), label[pairs % len(label)]
        yes += np.bincount(bucket[of > 0], minlength=buckets)
        no += np.bincount(bucket[of == 0], minlength=buckets)
    prior = label.mean()
    return np.log((yes + _SMOOTHING * prior) / (no + _SMOOTHING * (1 - prior)) * (1 - prior) / prior).astype(np.float32)


def _held(w: Windows, step: int = 200):
    """Distinct words of runs of documents: ``(words, documents)``."""
    first = w.texts.first
    for a in range(0, len(w.texts), step):
        b = min(a + step, len(w.texts))
        document = np.repeat(np.arange(a, b), np.diff(first[a : b + 1]))
        pairs = np.unique(document * len(w.vocabulary) + w.number[first[a] : first[b]])
        yield pairs % max(len(w.vocabulary), 1), pairs // max(len(w.vocabulary), 1)


def _grams(v: gru.Vocabulary, held):
    for word, document in held:
        size = np.diff(v.first)[word]
        at = np.repeat(v.first[word] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        yield v.grams[at], np.repeat(document, size)


def train(column, label: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> gru.Network:
    """A network for the texts of ``column`` and their labels (0 or 1, both present)."""
    rng = np.random.default_rng(seed)
    w, net = Windows(column), gru.Network(seed)
    v = w.vocabulary
    odds = _log_odds(((v.word[word], document) for word, document in _held(w)), label, gru.WORD_BUCKETS)
    net.p["word"][:, 0] = odds
    net.p["char"][:, 0] = _log_odds(_grams(v, _held(w)), label, gru.CHAR_BUCKETS)
    # The most telling window of each document, and random windows of unlabelled ones.
    value = np.maximum(odds[v.word], 0) + np.maximum(net.inputs(v)[:, gru.WORD_SIZE], 0)
    upto = np.concatenate([[0], np.cumsum((value ** 2)[w.number])])
    telling = upto[w.start + w.size] - upto[w.start]
    best = np.lexsort((-telling, w.text))
    best = best[np.r_[True, w.text[best][1:] != w.text[best][:-1]]] if len(best) else best
    negative = np.flatnonzero(label[w.text] == 0)
    chosen = np.concatenate([best, rng.choice(negative, min(len(negative), len(best)), replace=False)])
    y = label[w.text[chosen]].astype(np.float32)
    weight = np.where(y > 0, max(1.0, 0.5 * (len(y) - y.sum()) / max(y.sum(), 1)), 1.0).astype(np.float32)
    adam = gru.Adam(net.p)
    for epoch in range(epochs):
        adam.rate = 0.01 * 0.7**epoch
        order = rng.permutation(len(chosen))
        for a in range(0, len(order), BATCH):
            pick = order[a : a + BATCH]
            grid, mask = w.grid(chosen[pick], int(w.size[chosen[pick]].max()))
            used, local = np.unique(grid, return_inverse=True)
            sizes = np.diff(v.first)[used]
            grams = np.concatenate([v.grams[v.first[i] : v.first[i + 1]] for i in used])
            small = gru.Vocabulary(v.word[used], grams, np.concatenate([[0], np.cumsum(sizes)]))
            _, grad = net.gradients(small, local.reshape(grid.shape), mask, y[pick], weight[pick])
            adam.step(grad)
    return net


def score_texts(net: gru.Network, column, empty: float, lanes: int = 2048) -> np.ndarray:
    """The highest window score of each text."""
    w = Windows(column)
    gates = net.gates(net.inputs(w.vocabulary))
    out = np.full(len(w.texts), -np.inf)
    for full in (True, False):
        chosen = np.flatnonzero((w.size == WINDOW) == full)
        if not full:
            chosen = chosen[np.argsort(w.size[chosen], kind="stable")]
        for a in range(0, len(chosen), lanes):
            some = chosen[a : a + lanes]
            grid, mask = w.grid(some, int(w.size[some].max()))
            np.maximum.at(out, w.text[some], net.forward(gates, grid, None if full else mask))
    scores = 1 / (1 + np.exp(-np.clip(out, -60, 60)))
    return np.where(np.isneginf(out), empty, scores)


def sample(docs: DataFrame, labels: DataFrame, label: str = "toxic"):
    """Texts and labels of the bounded training sample."""
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (remainder_of(F.col("doc_id")) != 0))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .withColumn("draw", F.xxhash64(F.lit(SEED), "doc_id"))
    )
    ids = []
    for value, most in ((1, MAX_POSITIVE), (0, MAX_NEGATIVE)):
        ids += known.where(F.col("label") == value).orderBy("draw", "doc_id").limit(most).select("doc_id", "label").collect()
    spark = docs.sparkSession
    chosen = spark.createDataFrame(ids, "doc_id long, label int")  # at most MAX_POSITIVE + MAX_NEGATIVE rows
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .where(F.length("text") <= MAX_CHARS)
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")  # one row per id, so that the bound holds
        .agg(F.min("text").alias("text"))
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("text", "ascending")])
    )
    return rows.column("text"), rows.column("label").to_numpy()


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``."""
    texts, label = sample(docs, labels)
    share = float(label.mean()) if len(label) else 0.0
    base = min(share, 0.49)  # nothing in a text without words speaks for the label
    net = train(texts, label) if 0 < share < 1 else None
    shared = docs.sparkSession.sparkContext.broadcast(net)  # of a fixed size

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices_of(batch, 4 << 20):
                net = shared.value
                scores = score_texts(net, rows.column("text"), base) if net else np.full(rows.num_rows, base)
                yield pa.record_batch([rows.column("doc_id").cast(pa.int64()), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, labels).select(
        "doc_id",
        (remainder_of(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
