"""Operators 5 to 8: whole-table properties, plain Python and SQL."""

from __future__ import annotations

import collections
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from adevents.llm import mixing, quality, sharding, url_filter

from . import brute
from .conftest import same, written


def test_shards_are_contiguous_balanced_and_gapless(docs, rows):
    got = sharding.shard_digest(docs).collect()
    size = collections.Counter()
    for r in rows:
        raw = (r["text"] or "").encode()
        size[r["doc_id"], len(raw) + 8, zlib.crc32(raw)] += 1
    assert size == collections.Counter((g.doc_id, g["size"], g.text_crc32) for g in got)
    ordered = sorted(got, key=lambda g: g.start)
    total, start = sum(g["size"] for g in got), 0
    slots = collections.Counter()
    for g in ordered:
        assert g.start == start and g.law == "bytes" and g.grown_shard is None
        assert g.shard == min((2 * start + g["size"]) * 24 // (2 * total), 23) and g.slot == slots[g.shard]
        slots[g.shard] += 1
        start += g["size"]
    assert [g.doc_id for g in ordered if g.doc_id is not None] == sorted(r["doc_id"] for r in rows if r["doc_id"] is not None)


def test_shard_documents_keeps_rows_and_columns(spark, docs, no_docs, tmp_path):
    got = sharding.shard_documents(docs, 4)
    assert sorted(got.columns) == sorted({*docs.columns, "slot"})
    assert got.count() == docs.count() and {r.shard for r in got.select("shard").distinct().collect()} <= {0, 1, 2, 3}
    sharding.write_shards(docs, str(tmp_path / "s"), 4)
    assert spark.read.parquet(str(tmp_path / "s")).count() == docs.count()
    assert sharding.shard_digest(no_docs).count() == 0


def _base_counts(text):
    x = brute.WORD.findall(text)
    windows = [tuple(x[i : i + 5]) for i in range(len(x) - 4)]
    n = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if brute.WORD.search(line)]
    return (len(x), sum(map(len, x)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_quality_base_counts(docs, pairs):
    want = []
    for d, t in pairs:
        n, *rest, repeated = _base_counts(t or "")
        want.append((d, n, *rest, repeated, n < 10 or 100 * repeated > 20 * n))
    same(quality.quality_digest(docs), want, ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"])


def test_common_lines_are_removed_but_copies_are_no_evidence(spark, tmp_path):
    rng = random.Random(2)
    line = lambda: " ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=15))
    boiler, copied = "Share this page, like us and subscribe to our letter now!", "\n".join(line() for _ in range(4))
    rows = [(i, f"{line()}\n{boiler.upper() if i % 2 else boiler}\n{line()}", "h") for i in range(40)]
    rows += [(100 + i, copied, "h") for i in range(60)]  # copies of a good text
    rows += [(200 + i, f"{boiler}\n{boiler}\n{boiler}\n{boiler}\nan end {i} of it", "h") for i in range(3)]  # little else
    rows += [(300, f"{line()}\n{boiler}", "other"), (301, None, None), (302, boiler, None)]
    docs = written(spark, rows, "doc_id long, text string, source string", tmp_path / "q")
    got = {r.doc_id: r for r in quality.quality_digest(docs).collect()}
    assert all(got[i].kept and got[i].n_removed_words == 11 for i in range(40))
    assert all(got[100 + i].kept and got[100 + i].n_removed_words == 0 for i in range(60))
    assert not any(got[200 + i].kept for i in range(3)) and got[200].n_removed_words == 44
    assert got[300].n_removed_words == 0 and got[300].kept and not got[301].kept
    clean = {r.doc_id: r.text for r in quality.remove_common_lines(docs).collect()}
    assert "subscribe" not in clean[3] and clean[3].count("\n") == 1 and clean[100] == copied and clean[301] is None
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got.values())


def test_lines_shared_by_many_documents_with_few_own_lines_are_common(spark, tmp_path):
    rng = random.Random(5)
    line = lambda: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(6))
    shared = [line() for _ in range(20)]
    rows = [(i, "\n".join([*shared, line()]), "h") for i in range(120)]
    rows += [(1000 + i, "\n".join([line(), line()]), "h") for i in range(120)]
    copied = "\n".join(line() for _ in range(4))
    rows += [(2000 + i, copied, "h") for i in range(60)]
    docs = written(spark, rows, "doc_id long, text string, source string", tmp_path / "q")
    clean = {r.doc_id: r.text for r in quality.remove_common_lines(docs).collect()}
    assert all(clean[i] == rows[i][1].split("\n")[-1] for i in range(120))
    assert all(clean[d] == t for d, t, _ in rows[120:])
    assert sorted(r.doc_id for r in quality.keep_good(docs).collect()) == [d for d, *_ in rows[120:]]


def test_a_template_is_common_in_a_large_source_as_in_a_small_one(spark, tmp_path):
    template = "Read our terms of use before you order anything\nWe ship to all lands in ten days\nAsk the friendly staff for help"
    rows = [(1000 * h + i, f"{template}\nitem {'x' * i}", host) for h, host in enumerate(("small", "large")) for i in range(1, 31)]
    rows += [(5000 + i, "one two three four five six seven eight nine ten " + "y" * i, "large") for i in range(2000)]
    docs = written(spark, rows, "doc_id long, text string, source string", tmp_path / "q")
    assert sorted(r.doc_id for r in quality.keep_good(docs).collect()) == [d for d, *_ in rows[60:]]


def _good(rows):
    """doc ids that pass, by plain Python."""
    upper = str.maketrans({i: i + 32 for i in range(65, 91)})

    def norm(line):
        text = re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", line.translate(upper))
        return re.sub("[0-9]+", "0", text).strip(" ")

    holders = collections.defaultdict(set)
    lines = []
    for r in rows:
        found = [(norm(x), len(brute.WORD.findall(x))) for x in (r["text"] or "").split("\n")]
        lines.append([x for x in found if x[0]])
        for n, _ in lines[-1]:
            holders[r["source"], n].add(frozenset(x for x, _ in lines[-1]))
    out = []
    for r, found in zip(rows, lines):
        n, *_, repeated = _base_counts(r["text"] or "")
        gone = sum(w for x, w in found if len(holders[r["source"], x]) > quality.MIN_DOCS)
        if n >= 10 and 100 * repeated <= 20 * n and not (gone and (n - gone < quality.MIN_WORDS or gone > n * quality.MAX_REMOVED)):
            out.append(r)
    return out


def test_good_documents_equal_plain_python(spark, docs, rows, tmp_path):
    want = sorted((r["doc_id"] for r in _good(rows)), key=repr)
    assert 0 < len(want) < len(rows)
    assert sorted((r.doc_id for r in quality.keep_good(docs).collect()), key=repr) == want
    assert sorted((r.doc_id for r in quality.quality_digest(docs).where("kept").collect()), key=repr) == want


def test_quality_on_an_empty_table(no_docs):
    assert quality.quality_digest(no_docs).count() == 0


def test_host_path_and_canonical_form(spark):
    cases = {
        "https://A.Example.ORG:80/en/1?b=2&a=1&utm_x=3#top": ("a.example.org:80", "/en/1", "a.example.org:80/en/1?a=1&b=2"),
        "http://h?x": ("h", "", "h?x"), "http://h/p/#f?q": ("h", "/p/", "h/p"), "x/y": ("", "", ""), None: ("", "", ""),
        "http://h/a://b": ("h", "/a://b", "h/a://b"), "://": ("", "", ""), "http://É.com/p?ref=1": ("É.com", "/p", "É.com/p"),
    }
    at = F.col("url")
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    got = df.select(at, url_filter.host_of(at), url_filter.path_of(at), url_filter.canonical(at)).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == cases


@pytest.mark.parametrize("bytes_", [64 << 20, 0])
def test_verdicts_with_and_without_broadcast(spark, bytes_):
    urls = {
        1: ("http://b.example.org/es/x", "example.org/es/", "block"), 2: ("http://example.org/en/12", "example.org/en/1", "block"),
        3: ("http://other.org/en/1", "org/", "allow"), 4: ("http://a.com/fr/1", "com/fr/", "allow"), 5: ("http://a.com/de/", "com/de/", "block"),
        6: ("https://bad.net/x/?utm_a=1", None, "block"), 7: ("http://bad.net/y", None, "allow"), 8: (None, None, "allow"),
        9: ("https://bad.net/x", None, "block"), 10: ("http://xorg/", None, "allow"), 11: ("http://a.org", None, "allow"),
        12: ("http://bad.com/fr/x", "com/fr/", "allow"), 13: ("no url", None, "allow"),
    }
    pages = spark.createDataFrame([(k, u, "extra", "h") for k, (u, _, _) in urls.items()], "page_id long, url string, listed string, host string")
    listed = spark.createDataFrame([("bad.net/x",), ("bad.net/x",), ("bad.com/fr/x",), (None,), ("",)], "url string")
    got = url_filter.judge(pages, listed, broadcast_bytes=bytes_)
    same(got, [(k, r, v) for k, (_, r, v) in urls.items()], ["page_id", "rule", "verdict"])
    none = url_filter.judge(pages, listed.limit(0), broadcast_bytes=bytes_)
    assert none.where("listed").count() == 0 and none.count() == len(urls)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_the_production_list_decides_verdicts(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    listed = url_filter.listed_pages(pages)
    got = url_filter.judge(pages, listed)
    none = url_filter.judge(pages, listed.limit(0))
    blocked = lambda df: df.where("verdict = 'block'").count()
    by_list = got.where("rule IS NULL AND verdict = 'block'")
    assert by_list.count() == blocked(got) - blocked(none) > 0
    assert by_list.where("NOT listed").count() == 0 and got.where("listed AND rule IS NULL AND verdict = 'allow'").count() == 0
    assert got.count() == pages.count()


def test_urls_of_an_empty_table_and_very_long_ones(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.judge(none, url_filter.listed_pages(none)).count() == 0
    long = "http://free-bets.net/" + "x" * 200_000
    pages = spark.createDataFrame([(1, long), (2, long + "y"), (3, "http://not-free-bets.net/"), (4, "http://a.free-bets:80/")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge(pages, url_filter.listed_pages(pages.where("page_id <> 2"))).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow", 4: "block"}


def test_bloom_filter_has_no_false_negatives_and_few_false_positives(spark):
    pages = spark.range(20000).selectExpr("concat('u', id) as url")
    marked = url_filter.mark_listed(pages, spark.range(4000).selectExpr("concat('u', id) as url"))
    assert marked.where("listed").count() == 4000 == marked.where("listed and possible").count()
    assert marked.where("possible and not listed").count() < 16000 * 0.02


def _targets(size, weights=(5, 2, 1)):
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    target, free, rest = {}, set(order), 1.5 * sum(size.values())
    while free:
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * size[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * size[s]
            rest -= target[s]
        free -= over
    return target


def test_mix_meets_its_targets(docs, rows, no_docs):
    got = mixing.mix_digest(docs).collect()
    size, taken = collections.Counter(), collections.Counter()
    for r in rows:
        size[r["source"]] += len(brute.WORD.findall(r["text"] or ""))
    want = _targets(size)
    for g in got:
        assert g.source_size == size[g.source] and g.target == pytest.approx(want[g.source])
        assert g.taken in (0, g["size"], 2 * g["size"])
        taken[g.source] += g.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix_digest(docs).collect()), key=repr)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.where(F.coalesce(mixing.n_words_of(F.col("text")), F.lit(0)) > 0).count() == sum(g.taken // g["size"] for g in got if g["size"])
    assert mixing.mix_digest(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_fill_comes_as_near_as_any_choice(seed):
    rng = random.Random(seed)
    lengths = rng.sample(range(2, 40), 5)
    counts = [rng.randrange(1, 4) for _ in lengths]
    sums = {0}
    for n, c in zip(lengths, counts):
        sums = {s + n * k for s in sums for k in range(c + 1)}
    budget = rng.randrange(0, sum(n * c for n, c in zip(lengths, counts)) + 5)
    taken = mixing.fill(lengths, counts, budget)
    got = sum(n * t for n, t in zip(lengths, taken))
    assert all(0 <= t <= c for t, c in zip(taken, counts)) and got <= budget
    assert budget - got <= max(lengths)  # after proportional shares
    small = mixing.fill(lengths, [1] * 5, min(budget, sum(lengths)))
    ones = {0}
    for n in lengths:
        ones |= {s + n for s in ones}
    assert sum(n * t for n, t in zip(lengths, small)) == max(s for s in ones if s <= min(budget, sum(lengths)))
