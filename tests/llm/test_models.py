"""Operators 1 and 3, the pipeline, and the registered queries."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adevents.llm import gru, range_coder, token_files, tokens, toxicity

from .conftest import SCHEMA, long_words, prose, written


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 4), st.integers(0, range_coder.MAX_ID)), min_size=1, max_size=80), min_size=1, max_size=6))
def test_range_coder_round_trip(blocks):
    arrays = [np.array(b, np.uint16) for b in blocks]
    back = range_coder.decode_blocks(range_coder.encode_blocks(arrays), [len(b) for b in blocks])
    assert [b.tolist() for b in back] == blocks


def test_range_coder_compresses_and_blocks_are_independent():
    rng = np.random.default_rng(0)
    blocks = [np.tile(rng.integers(0, 50000, 40), 30).astype(np.uint16), rng.integers(0, 50000, 500).astype(np.uint16)]
    codes = range_coder.encode_blocks(blocks)
    assert len(codes[0]) < 2 * len(blocks[0]) / 6 and codes == [range_coder.encode_blocks([b])[0] for b in blocks]
    for b, c in zip(blocks, codes):
        assert (range_coder.decode_blocks([c], [len(b)])[0] == b).all()


def test_shares_of_a_row_are_kept_and_beat_one_order(docs):
    texts = [r.text or "" for r in docs.select("text").collect()]
    ids = tokens.encode(pa.array(texts), tokens.tokenizer_path())[0]
    shares = range_coder.Shares.of(ids)
    back = range_coder.Shares.read(shares.written())
    assert all((getattr(back, a) == getattr(shares, a)).all() for a in ("size", "start", "ids"))
    blocks = [ids[a : a + range_coder.BLOCK_IDS] for a in range(0, len(ids), range_coder.BLOCK_IDS)]
    codes = range_coder.encode_blocks(blocks, shares)
    nth = len(blocks) // 2  # one block by itself
    assert (range_coder.decode_blocks([codes[nth]], [len(blocks[nth])], back)[0] == blocks[nth]).all()
    p = np.bincount(ids) / len(ids)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum()
    assert 8 * sum(map(len, codes)) < entropy * len(ids)


def test_shares_of_every_id_and_of_one():
    everything = np.arange(range_coder.MAX_ID + 1).astype(np.uint16)
    for ids in (everything, np.array([range_coder.MAX_ID], np.uint16), np.zeros(3, np.uint16)):
        shares = range_coder.Shares.of(ids)
        blocks = [ids[a : a + 1024] for a in range(0, len(ids), 1024)]
        codes = range_coder.encode_blocks(blocks, shares)
        back = range_coder.decode_blocks(codes, [len(b) for b in blocks], range_coder.Shares.read(shares.written()))
        assert all((a == b).all() for a, b in zip(back, blocks))


def test_blocks_of_many_lengths_and_of_one_id_over_and_over():
    rng = np.random.default_rng(2)
    blocks = [np.full(n, i, np.uint16) for n, i in ((1024, 0), (1, range_coder.MAX_ID), (700, range_coder.MAX_ID), (3, 0))]
    blocks += [rng.integers(0, range_coder.MAX_ID + 1, n).astype(np.uint16) for n in rng.integers(1, 1024, 40).tolist()]
    blocks += [np.tile(rng.integers(0, 9, 2), 300).astype(np.uint16) for _ in range(40)]
    shares = range_coder.Shares.of(np.concatenate(blocks))
    codes = range_coder.encode_blocks(blocks, shares)
    back = range_coder.decode_blocks(codes, [len(b) for b in blocks], shares)
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(back, blocks))
    assert len(codes[0]) < 100  # each id costs a small part of a bit
    assert range_coder.encode_blocks([]) == range_coder.decode_blocks([], []) == []


TRICKY = ["", "a", " a", "a ", "  a  b\n\n c", "x\u00a0 y", "x\u00a0\ny", "\u3000 \u3000a", "don't  stop", "é\u2003 ß", "a<|endoftext|> b <|endoftext|>", "\x1c \x85 z", "日本 語\t\t"]


def test_chunked_tokens_equal_whole_text_tokens(pairs):
    path = tokens.tokenizer_path()
    texts = TRICKY + [t for _, t in pairs] + [w + " " + w for w in long_words()]
    ids, counts = tokens.encode(pa.array(texts), path)
    whole = [e.ids for e in tokens.load(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == whole


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from(" \n\t\u00a0\u2003\u0085aé'1s.-語")))
def test_chunked_tokens_of_random_space(text):
    path = tokens.tokenizer_path()
    assert tokens.encode(pa.array([text]), path)[0].tolist() == tokens.load(path).encode(text, add_special_tokens=False).ids


def test_words_of_letters_go_to_the_model_without_the_pattern(monkeypatch):
    path = tokens.tokenizer_path()
    letters = [chr(c) for c in range(0x21, 0x250)]
    texts = [f"{a}b{x}y {x} ab{x}" for x in letters for a in ("", " ", "q")] + [" ".join(letters), "".join(letters)]
    whole = [e.ids for e in tokens.load(path).encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(tokens, "_MEMORY", {})
    ids, counts = tokens.encode(pa.array(texts), path)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == whole

    class Pattern:
        def __getattr__(self, name):
            assert not name.startswith("encode")
            return getattr(tok, name)

    tok, words = tokens.load(path), " vorher ñandú über Łódź x"
    want = tok.encode(words, add_special_tokens=False).ids
    monkeypatch.setattr(tokens, "_MEMORY", {})
    monkeypatch.setitem(tokens._TOKENIZERS, path, Pattern())
    assert tokens.encode(pa.array([words]), path)[0].tolist() == want


def test_other_tokenizers_and_letters_as_special_tokens_keep_the_pattern(tmp_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.tokenizer_path())
    tok.add_special_tokens(["abc"])
    tok.save(path := str(tmp_path / "special.json"))
    assert tokens._of_words(tokens.tokenizer_path()) is not None and tokens._of_words(path) is None
    texts = ["xabcy abc", " abc d"]
    whole = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    ids, counts = tokens.encode(pa.array(texts), path)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == whole


def test_chunks_are_found_when_slots_are_shared():
    memory = tokens._Memory()
    keys = np.arange(1, 4001, dtype=np.uint64) << np.uint64(3)  # few first slots
    for a in range(0, 4000, 500):
        n = np.arange(500)
        data = np.full(500, a % 251, np.uint8)
        memory.add(keys[a : a + 500], data, n, np.ones(500, np.int64), np.ones(500, np.int64), n.astype(np.uint16), n[::-1])
        assert (memory.find(keys[: a + 500]) == np.arange(a + 500)).all()
        assert (memory.find(keys[a + 500 :]) == -1).all() and (memory.find(keys + np.uint64(1)) == -1).all()
    memory.again[::5] = True
    memory.forget()
    assert (memory.find(keys)[::5] == np.arange(800)).all() and (memory.find(keys) >= 0).sum() == 800
    assert (memory.ids == np.tile(499 - np.arange(0, 500, 5), 8)).all()


def test_joined_crc32():
    data = bytes(range(256)) * 5
    pieces = [data[:3], data[3:700], b"", data[700:]]
    assert token_files.joined_crc32([(zlib.crc32(p), len(p)) for p in pieces]) == zlib.crc32(data)


def _want(rows):
    tok, out, at = tokens.load(tokens.tokenizer_path()), [], 0
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
        ids = np.array([*tok.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((r["doc_id"], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_token_files_equal_direct_tokenization(spark, docs, no_docs, rows, monkeypatch):
    want = sorted(map(repr, _want(rows)))
    assert sorted(repr(tuple(r)) for r in token_files.token_digest(docs).collect()) == want
    path = token_files.write_tokens(docs)
    total = sum(len(r.ids) for r in token_files.read_pieces(spark, path).select("ids").collect())
    assert total == sum(eval(w)[2] for w in want)
    assert token_files.token_digest(no_docs).count() == 0


def test_small_batches_write_the_same_documents(rows):
    writer, out = token_files._Writer(0), []
    for r in sorted((r for r in rows if r["doc_id"] is not None), key=lambda r: r["doc_id"]):
        writer.add([r["doc_id"]], *tokens.encode(pa.array([r["text"]], pa.string()), tokens.tokenizer_path()))
        out += writer.rows(everything=False)
    out += writer.rows(everything=True)
    seen: dict = {}
    for batch, _, _, nth, doc_id, ids in token_files._with_pieces(iter(out)):
        for n, d, x in zip(nth, doc_id, ids):
            seen.setdefault((n, d), []).extend(x.tolist())
    assert [(d, len(x)) for (_, d), x in sorted(seen.items())] == [(d, n) for d, _, n, _ in _want(rows) if d is not None]


def test_a_changed_block_is_noticed(spark, docs):
    path = token_files.write_tokens(docs)
    broken = path + "-broken"
    other = F.transform("blocks", lambda b: b.withField("crc32", b["crc32"] + 1))
    spark.read.parquet(path).withColumn("blocks", other).write.parquet(broken)
    with pytest.raises(Exception, match="checksum"):
        token_files.read_digest(spark, broken).count()


def test_gradients_match_finite_differences():
    net = gru.Network(3)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64) * (10 if k in ("word", "char") else 1)
    v = gru.vocabulary(["one", "two", "é"], np.array([5, 9, 12], np.uint64))
    at, mask = np.array([[0, 1], [1, 2], [2, 0]]), np.array([[True, True], [True, True], [True, False]])
    label, weight = np.array([1.0, 0.0]), np.array([1.0, 2.0])
    _, grad = net.gradients(v, at, mask, label, weight)
    rng = np.random.default_rng(0)
    for name in ("wf", "ub", "cb", "wa", "va", "wo", "bo", "word", "char"):
        table, g = net.p[name], grad[name]
        full = np.zeros_like(table)
        if isinstance(g, tuple):
            full[g[0]] = g[1]
        else:
            full[...] = g
        for _ in range(4):
            where = tuple(rng.integers(0, n) for n in table.shape)
            if name in ("word", "char"):
                where = (int((v.word if name == "word" else v.grams)[0]), where[1])
            old = table[where]
            values = []
            for e in (1e-4, -1e-4):
                table[where] = old + e
                values.append(net.gradients(v, at, mask, label, weight)[0])
            table[where] = old
            assert full[where] == pytest.approx((values[0] - values[1]) / 2e-4, rel=0.05, abs=2e-4)


def _toxic_rows(n=700):
    import random

    rng = random.Random(9)
    out = []
    for i in range(n):
        words = prose(rng, rng.randrange(5, 150)).split()
        toxic = int(i % 3 == 0)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "nasty", "scum" + rng.choice("abcdef")]))
        out.append((i, " ".join(words), toxic))
    return out


def test_toxicity_on_held_out_rows(spark, tmp_path):
    rows = _toxic_rows()
    docs = written(spark, [(i, t) for i, t, _ in rows] + [(5000, None), (5001, ""), (None, "vile nasty scuma")], "doc_id long, text string", tmp_path / "d")
    labels = written(spark, [(i, y) for i, _, y in rows] + [(1, None), (None, 1)], "doc_id long, toxic int", tmp_path / "l")
    got = {r.doc_id: r for r in toxicity.toxicity_digest(docs, labels).collect()}
    assert len(got) == len(rows) + 3 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert len(held) > 80 and np.mean([p == y for p, y in held]) > 0.95
    assert got[5000].predicted == got[5001].predicted == 0
    nothing = toxicity.toxicity_digest(docs, labels.limit(0))
    assert nothing.where("score <> 0").count() == 0


def test_a_long_text_is_scored_to_its_end():
    rows = _toxic_rows(400)
    net = toxicity.train(pa.array([t for _, t, _ in rows]), np.array([y for *_, y in rows]))
    clean = " ".join(["tha", "ering", "one", "anx"] * 3000)
    scores = toxicity.score_texts(net, pa.array([clean, clean + " vile nasty scuma", "vile nasty"]), 0.1)
    assert scores[0] < 0.5 < min(scores[1], scores[2])


def test_pipeline(spark, rows, tmp_path):
    import corpus_pipeline

    plain = SCHEMA.split(", row_id")[0]
    columns = [c.split()[0] for c in plain.split(", ")]
    written(spark, [{c: r[c] for c in columns} for r in rows], plain, tmp_path / "documents.parquet")
    item = " ".join(next(r["text"] for r in rows if r["text"] and 50 < len(r["text"].split()) < 150).split()[:12])
    written(spark, [(1, item)], "item_id long, text string", tmp_path / "benchmark.parquet")
    docs, counts = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, str(tmp_path)), "test")
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert len(rows) > counts[0] > counts[1] > counts[2] > 0
    assert docs.where(F.contains(F.translate("text", "\n", " "), F.lit(item))).count() == 0
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.columns == [*columns, "shard", "slot"] and result.count() == counts[3]
    assert sorted(map(repr, result.select("doc_id").collect())) == sorted(map(repr, docs.select("doc_id").collect()))


def test_pipeline_stages_equal_plain_python(spark, rows, tmp_path):
    import corpus_pipeline

    from . import brute
    from .test_table_operators import _good

    plain = SCHEMA  # with columns that the operators use inside
    written(spark, rows, plain, tmp_path / "documents.parquet")
    item = " ".join(next(r["text"] for r in rows if r["text"] and 50 < len(r["text"].split()) < 150).split()[:12])
    written(spark, [(1, item)], "item_id long, text string", tmp_path / "benchmark.parquet")
    stages = [stage for _, stage in corpus_pipeline.STAGES]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    key = lambda r: (repr(r["doc_id"]), r["text"])

    good = corpus_pipeline.saved(stages[0](spark, docs, str(tmp_path)), "test")
    want = _good(rows)
    assert sorted(map(key, good.collect())) == sorted(map(key, want))

    unique = corpus_pipeline.saved(stages[1](spark, good, str(tmp_path)), "test")
    component = {}
    for (doc_id, n, c), r in zip(brute.components([(r["doc_id"], r["text"]) for r in want]), want):
        component[key(r)] = ("set", c) if n else ("alone", key(r))
    kept = unique.collect()
    assert sorted(map(repr, (component[key(r)] for r in kept))) == sorted(map(repr, set(component.values())))

    clean = corpus_pipeline.saved(stages[2](spark, unique, str(tmp_path)), "test")
    hits = brute.contamination([(key(r), r["text"]) for r in kept], [(1, item)])
    assert sorted(map(key, clean.collect())) == sorted(h[0] for h in hits if not h[5])
    assert any(h[5] for h in hits) and clean.columns == docs.columns

    mixed = corpus_pipeline.saved(stages[3](spark, clean, str(tmp_path)), "test")
    assert set(map(key, mixed.collect())) <= set(map(key, clean.collect())) and mixed.columns == docs.columns
    shards = stages[4](spark, mixed, str(tmp_path))
    assert shards.count() == mixed.count() and sorted(shards.columns) == sorted([*docs.columns, "slot"])


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    written(spark, [], SCHEMA, tmp_path / "documents.parquet")
    written(spark, [(1, "a b")], "item_id long, text string", tmp_path / "benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_toxicity_of_empty_and_repeated_rows(spark, tmp_path):
    rows = _toxic_rows(120)
    repeated = rows + [rows[3]] * 50
    docs = written(spark, [(i, t, "x", 0.5) for i, t, _ in repeated], "doc_id long, text string, label string, score double", tmp_path / "d")
    labels = written(spark, [(i, y) for i, _, y in rows], "doc_id long, toxic int", tmp_path / "l")
    assert toxicity.sample(docs, labels)[1].tolist() == toxicity.sample(docs.distinct(), labels)[1].tolist()
    got = toxicity.toxicity_digest(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == len(repeated)
    assert len({r.score for r in got.where("doc_id = 3").collect()}) == 1
    assert toxicity.toxicity_digest(docs.limit(0), labels).count() == 0


def test_a_run_of_half_a_window_is_whole_in_some_window():
    w = toxicity.Windows(pa.array([" ".join(f"w{i}" for i in range(n)) for n in (1, 64, 65, 130, 1000)]))
    half = toxicity.WINDOW // 2
    for text, n in enumerate(w.texts.n_words.tolist()):
        spans = [(a - w.texts.first[text], a - w.texts.first[text] + s) for a, s in zip(w.start[w.text == text], w.size[w.text == text])]
        assert all(any(a <= i and i + half <= b for a, b in spans) for i in range(max(1, n - half + 1))) or n < half


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names


def test_codes_stay_readable():
    """The coder's bytes are a file format: those of before its integers were narrowed."""
    import zlib

    from adevents.llm import range_coder, tokens

    n = np.arange(9000, dtype=np.uint64)
    ids = ((n * n * np.uint64(2654435761) >> np.uint64(16)) % np.uint64(97) * np.uint64(675)).astype(np.uint16)
    ids[::7] = range_coder.MAX_ID
    blocks = [ids[:5000], ids[5000:5001], ids[5001:]]
    for shares, crc in ((range_coder.Shares.of(ids), 3715420284), (None, 2031893067)):
        codes = range_coder.encode_blocks(blocks, shares)
        assert zlib.crc32(b"".join(codes)) == crc
        for a, b in zip(blocks, range_coder.decode_blocks(codes, [len(b) for b in blocks], shares)):
            assert (a == b).all()
    keys, example, which = tokens._distinct(n * n % np.uint64(11))
    assert (keys == np.unique(n * n % np.uint64(11))).all() and (keys[which] == n * n % np.uint64(11)).all()
    assert (keys == (n * n % np.uint64(11))[example]).all()
    assert all(len(x) == 0 for x in tokens._distinct(np.zeros(0, np.uint64)))


def test_remembered_chunks_are_bounded_and_the_common_ones_stay(monkeypatch):
    path = tokens.tokenizer_path()
    monkeypatch.setattr(tokens, "_MEMORY", {})
    monkeypatch.setattr(tokens, "REMEMBER", 300, raising=True)
    common = " the quick fox, (and) ünïcode\u00a0words 12.5"
    for i in range(20):
        texts = [f"{common} w{i}x{j} {j}-{i}/y\n" for j in range(40)] + [None, ""]
        ids, counts = tokens.encode(pa.array(texts), path)
        whole = [e.ids for e in tokens.load(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
        assert ids.tolist() == [x for one in whole for x in one] and counts.tolist() == [len(x) for x in whole]
        memory = tokens._MEMORY[path]
        assert len(memory.keys) <= 300 + 200
        assert len({len(x) for x in (memory.keys, memory.place, memory.size, memory.start, memory.count, memory.again)}) == 1
        assert memory.size.sum() == len(memory.data) and memory.count.sum() == len(memory.ids)
    assert memory.again.sum() > 0
    memory.forget()
    held = {memory.data[a : a + n].tobytes() for a, n in zip(memory.place, memory.size)}
    assert {b" the", b" quick", b" fox"} <= held and len(held) < 100


def test_chunks_are_few_when_most_are_common(monkeypatch):
    path = tokens.tokenizer_path()
    monkeypatch.setattr(tokens, "_MEMORY", {})
    monkeypatch.setattr(tokens, "REMEMBER", 2)
    for _ in range(4):  # all are met again: more than half of what may be remembered
        assert tokens.encode(pa.array([" a b c d"]), path)[0].tolist() == tokens.load(path).encode(" a b c d", add_special_tokens=False).ids
        tokens.encode(pa.array([" e f"]), path)
        assert len(tokens._MEMORY[path].keys) <= 6


def test_a_large_vocabulary_is_encoded_once(monkeypatch):
    asked = []

    def one_id_each(data, start, end, path):
        asked.append(len(start))
        return np.arange(len(start)), np.ones(len(start), np.int64), (start % 50_000).astype(np.uint16)

    monkeypatch.setattr(tokens, "_MEMORY", {})
    monkeypatch.setattr(tokens, "_encode_chunks", one_id_each)
    texts = [" ".join(f"x{i:06d}" for i in range(a, a + 100_000)) for a in range(0, 600_000, 100_000)]
    first = [tokens.encode(pa.array([t]), tokens.tokenizer_path())[0] for t in texts]
    assert sum(asked) == 600_000
    again = [tokens.encode(pa.array([t]), tokens.tokenizer_path())[0] for t in texts]
    assert sum(asked) == 600_000
    assert all((a == b).all() for a, b in zip(first, again))
