from __future__ import annotations

import random

import pytest

WORDS = [a + b for a in ("th", "er", "on", "an", "re", "in", "ou") for b in ("a", "e", "ing", "tion", "é", "ß", "x")]


def prose(rng: random.Random, n: int) -> str:
    text = " ".join(rng.choice(WORDS) for _ in range(n))
    return text.replace(" ", "\n", 1) if n > 20 else text


def edited(rng: random.Random, text: str, n: int) -> str:
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(WORDS) + "z"
    return " ".join(words)


def thue_morse(n: int) -> str:
    """``n`` letters (a power of two) whose sums of powers cancel out modulo powers of two."""
    text = "a"
    while len(text) < n:
        text += text.translate({97: 98, 98: 97})
    return text


def long_words() -> list[str]:
    return [w for n in (512, 1024, 2048, 4096) for w in (thue_morse(n), thue_morse(n).translate({97: 98, 98: 97}))]


def make_rows() -> list[dict]:
    """Copies, near copies, shared passages, boilerplate, nulls, empties, repeated rows, one long text."""
    rng = random.Random(4)
    texts: list[str | None] = [prose(rng, rng.randrange(1, 300)) for _ in range(60)]
    base = prose(rng, 200)
    texts += [base] * 6 + [edited(rng, base, rng.randrange(1, 8)) for _ in range(25)]
    passage = prose(rng, 60)
    texts += [prose(rng, 40) + " " + passage + "\t" + prose(rng, 30) for _ in range(5)]
    texts += [passage + " " + passage[1:] + " " + passage, "ha " * 100, "one two", "one  two\n", "One Two", "x"]
    texts += [f"{prose(rng, 30)}\nAll rights reserved.\n{prose(rng, 30)}" for _ in range(30)]
    texts += ["All rights reserved.\nAll rights reserved.", None, None, "", " \t\n", "\u00a0 \u00a0", prose(rng, 6000)]
    # texts that differ in one very long word only
    shared = prose(rng, 34)
    texts += [f"{shared} {w}" for w in long_words()] + long_words()
    rows = [
        {"doc_id": i, "text": t, "lang": "en", "source": None if i % 11 == 0 else f"src{i % 3}", "n_chars": len(t or "")}
        for i, t in enumerate(texts)
    ]
    rows += [dict(rows[3]), dict(rows[3]), dict(rows[70])]  # repeated rows
    rows.append({**rows[5], "doc_id": None})
    rng.shuffle(rows)
    # names that the operators use inside
    return [r | {"row_id": 1, "block": "b", "part": None, "size": "s", "key": 0, "copy": 2, "shard": 9, "label": 1} for r in rows]


SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row_id int, block string, part int, "
    "size string, key int, copy int, shard int, label int"
)


def written(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(path))
    return spark.read.parquet(str(path))


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def pairs(rows):
    return [(r["doc_id"], r["text"]) for r in rows]


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    return written(spark, rows, SCHEMA, tmp_path_factory.mktemp("llm") / "documents")


@pytest.fixture(scope="session")
def no_docs(spark, tmp_path_factory):
    return written(spark, [], SCHEMA, tmp_path_factory.mktemp("llm") / "none")


def same(df, want, columns):
    """The rows of ``df`` as a sorted list equal ``want``'s."""
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
