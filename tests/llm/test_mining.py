"""Operators 12 and 13 against plain Python and SQL."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from adevents.llm import collocations, hadamard_clusters, oracles
from adevents.llm.collocations import Summary

from . import brute
from .conftest import same, written


def _collocations(rows, threshold, first):
    counts: dict = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    counts["und" if lang is None else lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: c for p, c in f.items() if len(p) > 1 and c >= threshold}
        longer: collections.Counter = collections.Counter()
        for p, c in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], c)
        scored = []
        for p, a in found.items():
            if longer[p] < a:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (score, a, p, left, right) in enumerate(sorted(scored)[:first]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n, -score))
    return out


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("threshold,first", [(3, 2000), (2, 25), (40, 2000)])
def test_collocations_equal_brute_force(spark, rows, tmp_path, threshold, first):
    rng = random.Random(1)
    words = ["Alpha", "beta", "gamma", "é", "x,y", "delta.", "one\ttwo", "st;op"]
    texts = [(rng.choice(["en", "de", None, "und"]), " ".join(rng.choices(words, k=rng.randrange(0, 40)))) for _ in range(150)]
    texts += [(r["lang"], r["text"]) for r in rows] + [("en", None), (None, None), ("en", ""), ("xx", "... ;\n"), ("yy", "ha " * 500)]
    docs = written(spark, [(i, t, lang, "h", 0) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string, phrase string, n int", tmp_path / "d")
    want = _collocations(texts, threshold, first)
    assert len(want) > 20
    same(collocations.collocations(docs, threshold, first), want, COLUMNS)


def test_collocations_of_an_empty_table(no_docs):
    assert collocations.collocations(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_every_frequent_key_survives_any_merges(seed):
    rng = np.random.default_rng(seed)
    stream = np.minimum(rng.zipf(1.3, 30_000), 5000).astype(np.uint64)
    threshold = 150
    truth = collections.Counter(stream.tolist())
    whole = [Summary(len(stream) // threshold) for _ in range(3)]
    for i, part in enumerate(np.array_split(stream, rng.integers(3, 60))):  # in three branches, merged last
        keys, counts = np.unique(part, return_counts=True)
        whole[i % 3].merge(keys, counts)
    one = whole[0]
    for other in whole[1:]:
        lost = other.lost
        one.merge(other.keys, other.counts)
        one.lost += lost
    held = dict(zip(one.keys.tolist(), one.counts.tolist()))
    assert len(held) <= len(stream) // threshold and one.lost < threshold
    for key, n in truth.items():
        assert n - one.lost <= held.get(key, 0) <= n
        assert n < threshold or key in held


def test_misra_gries_drops_most_rare_phrases(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(30)], k=60)) for _ in range(100)]
    docs = written(spark, [(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string", tmp_path / "d")
    sizes = []
    merge = Summary.merge

    def watched(self, keys, counts):
        merge(self, keys, counts)
        sizes.append((len(self.keys), self.capacity))

    monkeypatch.setattr(Summary, "merge", watched)
    reply = collocations._survivors(50)
    keys = np.sort(rng_keys := np.random.default_rng(0).integers(0, 1 << 60, 5000).astype(np.uint64))
    payloads = [collocations.B.pack_arrays(*collocations._cut(keys[i::4], np.ones(1250, np.int64), 1, 64)[0]) for i in range(4)]
    assert len(list(reply(payloads))) == 4 and len(rng_keys) == 5000
    assert sizes and all(n <= capacity for n, capacity in sizes) and sizes[-1][1] == 100
    want = _collocations([("en", t) for t in texts], 50, 100)
    same(collocations.collocations(docs, 50, 100), want, COLUMNS)


# ---- clusters ----------------------------------------------------------------


def _clusters(rows, k, rounds):
    kept = []
    for vec_id, x in rows:
        if x is not None and len(x) == 64 and all(e is not None and np.isfinite(e) for e in x):
            kept.append((vec_id, [int(np.floor(256 * np.float64(np.float32(e)))) for e in x], x))
    digest = lambda v: hashlib.sha256(f"2:{'' if v is None else v}".encode()).hexdigest()
    centroids = [x for _, x, _ in sorted(kept, key=lambda r: (digest(r[0]), r[2]))[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, x, _ in kept:
            groups[nearest(x)[1]].append(x)
        centroids = [[sum(e) // len(groups[i]) for e in zip(*groups[i])] if i in groups else c for i, c in enumerate(centroids)]
    placed = [(v, *nearest(x)[::-1]) for v, x, _ in kept]
    inertia = collections.Counter()
    for _, i, d in placed:
        inertia[i] += d
    name = lambda i: hashlib.sha256(",".join(map(str, centroids[i])).encode()).hexdigest()
    return [(v, i, d, inertia[i], sum(inertia.values()), name(i)) for v, i, d in placed]


DIGEST = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
VECTORS = "vec_id long, embedding array<float>, label int, cluster string, distance int"


def _vectors(rng, n):
    rows = [(i, [float(np.float32(e)) for e in rng.normal(0, 0.3, 64) + (i % 5)]) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)] + [rows[4], rows[4], (None, rows[7][1])]
    rows += [(2000, None), (2001, [0.5] * 63), (2002, [0.5] * 65), (2003, [0.5] * 63 + [None]), (2004, [float("nan")] + [0.5] * 63)]
    return rows + [(2005, [float("inf")] + [0.5] * 63), (2006, []), (2007, [0.0] * 64), (2008, [-0.001] * 64)]


@pytest.mark.parametrize("k,rounds", [(40, 5), (3, 2), (500, 1)])
def test_clusters_equal_brute_force(spark, tmp_path, k, rounds):
    rows = _vectors(np.random.default_rng(k), 120)
    table = written(spark, [(v, x, 1, "c", 2) for v, x in rows], VECTORS, tmp_path / "v")
    same(hadamard_clusters.cluster_digest(table, k, rounds), _clusters(rows, k, rounds), DIGEST)


def test_clusters_of_large_components_and_of_nothing(spark, tmp_path):
    rng = np.random.default_rng(1)
    for i, scale in enumerate((1e3, 7e4)):
        rows = [(j, [float(np.float32(e)) for e in rng.normal(0, scale, 64)]) for j in range(30)]
        table = written(spark, [(v, x, 1, "c", 2) for v, x in rows], VECTORS, tmp_path / f"v{i}")
        same(hadamard_clusters.cluster_digest(table, 4, 2), _clusters(rows, 4, 2), DIGEST)
    none = written(spark, [(1, None, 1, "c", 2)], VECTORS, tmp_path / "none")
    assert hadamard_clusters.cluster_digest(none).count() == 0
    far = written(spark, [(1, [1e30] * 64, 1, "c", 2), (2, [-1e30] * 64, 1, "c", 2)], VECTORS, tmp_path / "far")
    assert {r.distance for r in hadamard_clusters.cluster_digest(far, 2, 1).collect()} == {0}
    with pytest.raises(Exception, match="(?i)int"):
        hadamard_clusters.assign(far, hadamard_clusters.first_centroids(far, 1)).count()


def test_transform_is_orthogonal_and_ordered_by_sign_changes():
    one = hadamard_clusters.coefficients(np.eye(64, dtype=np.int64))
    assert (one.T @ one == 64 * np.eye(64)).all()
    assert [(np.diff(c) != 0).sum() for c in one.T] == list(range(64))


@pytest.mark.parametrize("scale", [300, 1 << 20, 1 << 28])
def test_search_equals_all_distances(scale):
    rng = np.random.default_rng(scale)
    v = rng.integers(-scale, scale, (150, 64))
    c = v[:40] + rng.integers(-50, 50, (40, 64))
    c[7], v[50:60] = c[3], c[3]  # ties
    whole = ((v[:, None].astype(object) - c[None].astype(object)) ** 2).sum(-1)
    number, distance = hadamard_clusters.search(v, c)
    assert (number == whole.argmin(1)).all() and (distance == whole.min(1)).all()


def test_sql_of_collocations_and_clusters(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, run, table in (
        ("op12_collocations", collocations.collocations, "documents"),
        ("op13_hadamard_clusters", hadamard_clusters.cluster_digest, "embeddings"),
    ):
        found = con.execute(oracles.ORACLES[name])
        columns = [d[0] for d in found.description]
        same(run(spark.read.parquet(f"{sf}/{table}.parquet")), found.fetchall(), columns)


def test_runs_are_sorted_once_and_survive_together():
    import pyarrow as pa

    rows = pa.table({"lang": ["en", None, "en"], "text": ["a b c a b c, a b", "a b c", None]})
    p = collocations.Phrases(rows)
    assert p.every_word() is p.every_word()  # words are sorted once for their numbers and their keys
    for k, places in ((1, p.every_word().at), *((k, p.starts(k)) for k in range(2, 6))):
        p.runs[k] = runs = collocations._Runs(places, p.keys(places, k, 64))
        bits = 20
        n = len(np.unique(p.keys(places, k, bits)))
        flags = np.arange(n) % 2 == 0
        reply = [collocations.B.pack_arrays(np.array([n]), collocations.B.bits_of(flags))]
        found, which = np.unique(p.keys(places, k, bits), return_inverse=True)
        assert runs.keep(reply, 0, bits).tolist() == flags[which].tolist()
        runs.kept[:] = True
    entries = collocations._Entries(p, 64)
    raw = p.texts.data.tobytes()
    want: collections.Counter = collections.Counter()
    for k in range(1, 6):
        for i in (p.every_word().at if k == 1 else p.starts(k)).tolist():
            want[p.lang[i], raw[p.texts.start[i] : p.texts.end[i + k - 1]]] += 1
    got = {
        (p.lang[i], raw[p.texts.start[i] : p.texts.end[i + k - 1]]): n
        for i, k, n in zip(entries.example.tolist(), entries.words.tolist(), entries.counts.tolist())
    }
    assert got == dict(want) and len(got) == len(entries.keys)
    text = collocations._by_text(p, entries.example, entries.words, entries.counts)
    assert sorted(zip(text["phrase"].to_pylist(), text["n"].to_pylist())) == sorted((w.decode(), n) for (_, w), n in got.items())
