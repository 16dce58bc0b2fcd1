"""Operators 2, 4, 9 and 10 against plain Python."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from adevents.llm import blocks, contamination, jaccard_join, katz, substring_dedup
from adevents.llm.common import remainder_of
from adevents.llm.words import ALNUM, Texts

from . import brute
from .conftest import SCHEMA, same, written


def test_words_of_bytes_match_the_patterns():
    import pyarrow as pa

    texts = ["a b", None, "", "x", "Ab-cd é\u00a0ß 9z", " \t\n", "end", "\x1f|"]
    for pattern, table in ((brute.WORD, None), (brute.ALNUM, ALNUM)):
        t = Texts(pa.array(texts), lower=True) if table is None else Texts(pa.array(texts), table, lower=True)
        raw = t.data.tobytes()
        words = [raw[a:b].decode() for a, b in zip(t.start, t.end)]
        assert words == [w for x in texts for w in pattern.findall(brute.lower(x or ""))]
        assert t.n_words.tolist() == [len(pattern.findall(x or "")) for x in texts]


def test_hashes_tell_long_words_and_windows_apart():
    import pyarrow as pa

    from adevents.llm.words import Windows, same_ranges

    from .conftest import long_words

    words = [*long_words(), "x" * 127, "x" * 128, "x" * 129, "", "x", "x\0", "abcdefgh", "abcdefgh\0"]
    t = Texts(pa.array(words), np.ones(256, bool))
    t.start, t.end = t.offsets[:-1], t.offsets[1:]
    assert len(set(t.hashes().tolist())) == len(words)
    assert same_ranges(t.data, t.start, t.end, t.data, t.start).all()
    assert not same_ranges(t.data, t.start[0:8:2], t.end[0:8:2], t.data, t.start[1:8:2]).any()
    rng = np.random.default_rng(0)
    one, two = rng.integers(0, 1 << 63, 2).astype(np.uint64)
    for n in (1, 2, 5, 15, 35, 1024):
        bits = np.array([bin(i).count("1") % 2 for i in range(n)], bool)
        a, b = np.where(bits, one, two), np.where(bits, two, one)
        both = Windows(np.concatenate([a, b, a])).at(np.array([0, n, 2 * n]), n)
        assert both[0] == both[2] != both[1]
        assert Windows(a, second=True).at(np.array([0]), n)[0] != both[0]


def test_substring_dedup_equals_brute_force(docs, pairs):
    want = [(d, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, n, gone, kept in brute.substring(pairs, 35)]
    same(substring_dedup.dedup_digest(docs), want, ["doc_id", "n_words", "n_removed", "kept_sha256"])


@pytest.mark.parametrize("window,period", [(4, 2), (12, 7), (5, 1)])
def test_substring_dedup_with_other_windows(docs, pairs, window, period):
    size = F.aggregate("removed", F.lit(0), lambda a, r: a + r["end"] - r["start"]).cast("long")
    found = substring_dedup.find_and_remove(docs, window, period).withColumn("gone", size)
    same(found, brute.substring(pairs, window), ["doc_id", "n_words", "gone", "kept_text"])


@pytest.mark.parametrize("period", [1, 2, 5, 7, 13, 21])
def test_difference_cover(period):
    cover = substring_dedup.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def _items(spark, pairs, tmp_path):
    from .conftest import long_words

    long = [t for _, t in pairs if t and 40 < len(t.split()) < 200]
    items = [(i, " ".join(t.split()[5:25])) for i, t in enumerate(long[:6])]
    items += [(10, "One, two"), (2, long[7][:90]), (11, None), (12, ""), (13, "--"), (None, " ".join(long[9].split()[:12]))]
    items.append(items[0])
    items += [(20 + i, w) for i, w in enumerate(long_words()[::2])]  # each in some texts, its complement in others
    return items, written(spark, items, "item_id long, text string", tmp_path / "items")


def test_decontamination_equals_brute_force(spark, docs, pairs, tmp_path):
    items, table = _items(spark, pairs, tmp_path)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = brute.contamination(pairs, items)
    assert any(w[5] for w in want)
    same(contamination.contamination_digest(docs, table), want, columns)
    # the benchmark in several chunks, over segments of a few documents
    index = contamination.build_index(docs, segment_bytes=2000)
    found = contamination.find_matches(spark, index, table, chunk_words=40)
    hit = [(d, n, h) for d, n, h, *_ in want]
    same(found.withColumn("n", contamination.n_hit_words(F.col("hits"))), hit, ["doc_id", "n_words", "n"])
    clean = contamination.clean_documents(docs, table)
    assert clean.columns == docs.columns
    same(clean, [(w[0],) for w in want if not w[5]], ["doc_id"])


def test_proximity_matches(spark, tmp_path):
    docs = written(spark, [(1, "a b x c d"), (2, "a b c d"), (3, "a x x x b c d"), (4, "c d"), (5, "a b")], "doc_id long, text string", tmp_path / "d")
    items = written(spark, [(1, "a b c d")], "item_id long, text string", tmp_path / "i")
    index = contamination.build_index(docs)

    def ids(slop):
        found = contamination.find_matches(spark, index, items, slop=slop)
        return sorted(r.doc_id for r in found.where(F.size("hits") > 0).collect())

    assert (ids(0), ids(1), ids(3)) == ([2], [1, 2], [1, 2, 3])


def test_an_empty_benchmark_and_empty_documents(spark, docs, no_docs, tmp_path):
    none = written(spark, [], "item_id long, text string", tmp_path / "none")
    found = contamination.contamination_digest(docs, none)
    assert found.where("contaminated or n_items > 0").count() == 0 and found.count() == docs.count()
    assert contamination.contamination_digest(no_docs, none).count() == 0


def test_jaccard_join_equals_brute_force(docs, pairs):
    want = brute.components(pairs)
    same(jaccard_join.jaccard_digest(docs), want, ["doc_id", "n_shingles", "component_id"])
    kept = jaccard_join.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    groups = {(c, n == 0 and d) for d, n, c in want if n}
    assert kept.where(F.length(F.trim("text")) > 5).count() <= len(groups) + 1
    assert kept.count() == len({c for _, n, c in want if n}) + sum(n == 0 for _, n, _ in want)


def test_jaccard_join_of_a_large_family_in_several_cells(spark, tmp_path, monkeypatch):
    import random

    from .conftest import edited, prose

    rng = random.Random(1)
    base = prose(rng, 120)
    pairs = [(i, edited(rng, base, rng.randrange(0, 12))) for i in range(150)]
    docs = written(spark, pairs, "doc_id long, text string", tmp_path / "family")
    monkeypatch.setattr(jaccard_join, "CELL_TOKENS", 2000)
    same(jaccard_join.jaccard_digest(docs), brute.components(pairs), ["doc_id", "n_shingles", "component_id"])


def test_components_of_paths_and_stars(spark):
    from adevents.llm.graph import components

    edges = [(i, i + 1) for i in range(30)] + [(100, 90 - i) for i in range(10)] + [(200, 200), (300, 299)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(31)} | {i: 81 for i in [*range(81, 91), 100]} | {299: 299, 300: 299}


def test_a_long_chain_takes_few_steps(spark, monkeypatch):
    from adevents.llm import graph

    steps = []
    monkeypatch.setattr(graph, "saved", lambda df, name, save=graph.saved: steps.append(name) or save(df, name))
    edges = spark.createDataFrame([(i, i + 1) for i in range(2000)] + [(5000 - i, 5001 - i) for i in range(100)], "a long, b long")
    found = {r.node: r.root for r in graph.components(edges).collect()}
    assert found == {i: 0 for i in range(2001)} | {i: 4901 for i in range(4901, 5002)}
    assert steps.count("edges") <= 3 and steps.count("hooks") <= 15


@pytest.mark.parametrize("order", [1, 2, 3])
def test_katz_scores_equal_brute_force(docs, pairs, order):
    want, _, _ = brute.katz(pairs, order)
    rows = docs.select("doc_id", "text", (remainder_of(F.col("doc_id")) != 1).alias("train"))
    got = katz.score_documents(rows, order)
    key = lambda r: (repr(r[0]), r[1])
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got.collect()), key=key)
    want = sorted(((d, n, k, t, b, s) for d, _, n, k, t, b, s in want), key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    np.testing.assert_allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-9)


def test_katz_query_scores_trigrams_with_all_counted_ngrams(docs, pairs):
    want, prob, words = brute.katz(pairs, 3, min_count=1)
    key = lambda r: (repr(r[0]), r[2], r[-1])
    got = sorted((tuple(r) for r in katz.lm_digest(docs).collect()), key=key)
    want = sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    np.testing.assert_allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)
    for context in [("<s>", "<s>"), ("ha", "ha"), ("never", "tha")]:
        assert sum(prob(context, w) for w in words) + prob(context, "\0") == pytest.approx(1)


def zipf_texts(seed, n_docs, n_words, vocabulary=20_000):
    rng = np.random.default_rng(seed)
    words = (vocabulary ** rng.random((n_docs, n_words))).astype(int)
    return [" ".join(f"w{w}" for w in row) for row in words]


def test_katz_sends_every_token_once(spark, tmp_path, monkeypatch):
    """All messages between blocks and parts, in bytes for each token (36 when the n-grams of every order were sent)."""
    texts = zipf_texts(5, 300, 400)
    rows = written(spark, [(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, train boolean", tmp_path / "docs")
    sent = []

    def noting(made):
        return lambda *a, **k: sent.append(made(*a, **k)) or sent[-1]

    monkeypatch.setattr(blocks, "questions", noting(blocks.questions))
    monkeypatch.setattr(blocks, "answered", noting(blocks.answered))
    katz.score_documents(rows, 3, min_count=1)
    size = sum(x.agg(F.sum(F.length("payload"))).first()[0] for x in sent)
    assert size < 15 * 300 * 401


def test_katz_words_that_are_most_of_a_corpus(spark, tmp_path):
    """Tokens after common words are dealt by more than that word; contexts and counts are still whole."""
    texts = ["the " + t.replace(" ", " the ").replace("w1 ", "of ") for t in zipf_texts(6, 60, 50, 100)] + ["the the the " * 40] * 20
    pairs = [(i, t) for i, t in enumerate(texts)]
    rows = written(spark, pairs, "doc_id long, text string", tmp_path / "docs")
    rows = rows.withColumn("train", remainder_of(F.col("doc_id")) != 1)
    for order, min_count in ((2, 1), (3, 1), (4, 2)):
        want = {r[0]: r[-1] for r in brute.katz(pairs, order, min_count)[0]}
        got = {r.doc_id: r.score for r in katz.score_documents(rows, order, min_count=min_count).collect()}
        assert got == pytest.approx(want, rel=1e-9)


def test_katz_sums_to_one_and_beats_the_base(pairs):
    rows, prob, words = brute.katz(pairs)
    for context in [("<s>",), ("tha",), ("ha",), ("never",)]:
        assert sum(prob(context, w) for w in words) + prob(context, "\0") == pytest.approx(1)
    assert sum(r[6] for r in rows) > sum(r[5] for r in rows)


def test_katz_model_table_and_empty_input(spark, docs, no_docs):
    rows = docs.select("text", F.lit(True).alias("train"))
    table = spark.read.parquet(katz.write_model(rows, order=3))
    assert {r.order for r in table.select("order").distinct().collect()} == {2, 3}
    assert katz.lm_digest(no_docs).count() == 0
    untrained = katz.score_documents(docs.select("doc_id", "text", F.lit(False).alias("train")))
    assert untrained.where("n_known > 0 or train_tokens > 0 or score <> 0 or base_score <> 0").count() == 0


def test_text_operators_on_an_empty_table(no_docs):
    assert substring_dedup.dedup_digest(no_docs).count() == 0
    assert jaccard_join.jaccard_digest(no_docs).count() == 0
    assert no_docs.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")


def test_an_index_segment_needs_little_memory():
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(5)
    words = np.array([f"w{i}x" for i in range(5000)])
    texts = [" ".join(words[rng.integers(0, 5000, 400)]) for _ in range(contamination.SEGMENT_BYTES // 2400 + 1)]
    rows = pa.record_batch(
        {"row_id": pa.array(range(len(texts))), "doc_id": pa.array(range(len(texts))), "text": pa.array(texts)}
    )
    size = sum(map(len, texts))
    tracemalloc.start()
    segment = contamination._segment(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert segment.num_rows == 5001 and size > 0.9 * contamination.SEGMENT_BYTES
    assert peak < 100 << 20


@pytest.mark.parametrize("at_once", [1, 7, 1 << 15])
def test_ranges_taken_a_few_at_a_time_hash_and_compare_alike(monkeypatch, at_once):
    import pyarrow as pa

    from adevents.llm import words

    texts = Texts(pa.array(["a bb a " + "long" * 40 + " bb", None, "x" * 3000 + " a " + "x" * 3000, "abcdefgh abcdefghi"]))
    want = {}
    for h, a, b in zip(texts.hashes(seed=3).tolist(), texts.start, texts.end):
        assert want.setdefault(texts.data[a:b].tobytes(), h) == h
    assert len(set(want.values())) == len(want)
    monkeypatch.setattr(words, "_AT_ONCE", at_once)
    assert [want[texts.data[a:b].tobytes()] for a, b in zip(texts.start, texts.end)] == texts.hashes(seed=3).tolist()
    n = len(texts.start)
    one, two = np.repeat(np.arange(n), n), np.tile(np.arange(n), n)
    size = texts.end - texts.start
    alike = size[one] == size[two]
    one, two = one[alike], two[alike]
    got = words.same_ranges(texts.data, texts.start[one], texts.end[one], texts.data, texts.start[two])
    raw = texts.data.tobytes()
    word = [raw[a:b] for a, b in zip(texts.start, texts.end)]
    assert got.tolist() == [word[i] == word[j] for i, j in zip(one, two)]
