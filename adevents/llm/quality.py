"""Quality rules from cross-document line frequency, with per-document base counts.

Lines are normalised (A-Z lower-cased, runs of other ASCII than letters and
digits to one space, runs of digits to ``0``) and hashed.  A line is *common*
on a host when more than ``min_docs`` distinct documents hold it, however many
others the host has.  Copies must not make the lines
of a good text common, so documents of a host with equal sets of normalised
lines count as one; documents that differ in a line are different, however many
boilerplate lines they share.  Common lines are removed; a
document that loses more than ``max_removed`` of its words, or keeps fewer
than ``min_words``, is depleted and rejected.

Everything is DataFrame functions.  Lines are counted with two map-side
combined aggregates, so a line in a third of all documents sends one row per
task.  ``documents`` has no host column; its ``source`` plays that part.

Cases: a null text has no words and fails the base rules, a null host is a host
of its own, an empty table gives no rows, repeated rows are separate rows with
equal results (copies count once per host), further columns are kept by
:func:`keep_good` and ignored by the digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adevents.llm.common import as_table, ascii_lower, let, n_words_of, saved, spare_name, text_or_empty, with_row_id, words_of

MIN_DOCS = 20
MAX_REMOVED = 0.7
MIN_WORDS = 10
REPEAT_WINDOW = 5
SYMBOLS = "#*$%&|<>"
_NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(ascii_lower(line), _NOT_ALNUM, " "), "[0-9]+", "0"))


def hash60(text: Column) -> Column:
    """The first 60 bits of the md5."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _windows(words: Column) -> Column:
    n = F.size(words) - (REPEAT_WINDOW - 1)
    return F.when(
        n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, REPEAT_WINDOW)))
    ).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column) -> Column:
    """Words under windows that occur twice or more in the array of window hashes."""

    def among_sorted(s: Column) -> Column:
        twice = F.filter(
            s, lambda e, k: (F.get(s, k - 1)["x"] == e["x"]) | (F.get(s, k + 1)["x"] == e["x"])
        )
        starts = F.sort_array(F.transform(twice, lambda e: e["i"]))
        return let(
            starts,
            lambda p: F.aggregate(
                F.transform(
                    p,
                    lambda v, k: F.least(F.lit(REPEAT_WINDOW), F.coalesce(F.get(p, k + 1) - v, F.lit(REPEAT_WINDOW))),
                ),
                F.lit(0).cast("long"),
                lambda a, x: a + x,
            ),
        )

    return let(
        F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i")))), among_sorted
    )


def repeated_words(words: Column) -> Column:
    """Words in 5-word windows found twice or more in the text, the first included."""
    return let(
        _windows(words),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_covered(h)),
    )


def _word_facts(text: Column) -> Column:
    return let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )


def _duplicate_lines(lines: Column) -> Column:
    return let(
        F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    )


def _line_facts(lines: Column) -> Column:
    """Hash and word count of every line that has letters, digits or non-ASCII characters."""
    rows = F.transform(lines, lambda x: F.struct(normalised(x).alias("norm"), n_words_of(x).alias("words")))
    return F.transform(
        F.filter(rows, lambda r: r["norm"] != ""), lambda r: F.struct(hash60(r["norm"]).alias("key"), r["words"].alias("words"))
    )


def _facts(docs: DataFrame, host_col: str, *ids: Column) -> DataFrame:
    """One row per document, without its text: base counts and line hashes."""
    text = text_or_empty()
    lines = F.split(text, "\n")
    host = F.coalesce(F.concat(F.lit("s"), F.col(host_col).cast("string")), F.lit("n"))
    return (
        docs.select(
            *ids,
            host.alias("host"),
            _word_facts(text).alias("w"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            _duplicate_lines(lines).alias("n_dup_lines"),
            _line_facts(lines).alias("lines"),
        )
        .select("*", "w.*")
        .drop("w")
    )


def _line_set(keys: Column) -> Column:
    """A hash of the set of line hashes; null without lines."""
    return F.when(F.size(keys) > 0, F.xxhash64(F.sort_array(F.array_distinct(keys))))


def common_lines(facts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``host, key`` of the lines in more than ``min_docs`` distinct documents."""
    return (
        facts.select("host", _line_set(F.transform("lines", lambda x: x["key"])).alias("mark"), F.explode("lines").alias("line"))
        .groupBy("host", F.col("line.key").alias("key"))
        .agg(F.count_distinct("mark").alias("docs"))
        .where(F.col("docs") > min_docs)
        .select("host", "key")
    )


def _verdicts(facts: DataFrame, key: str, common: DataFrame) -> DataFrame:
    """``facts`` plus ``n_removed_words``, ``base_failed`` and ``kept``."""
    removed = (
        facts.select(key, "host", F.explode("lines").alias("line"))
        .select(key, "host", F.col("line.key").alias("key"), F.col("line.words").alias("words"))
        .join(common, ["host", "key"])
        .groupBy(key)
        .agg(F.sum("words").alias("n_removed_words"))
    )
    n, gone = F.col("n_words"), F.col("n_removed_words")
    depleted = (gone > 0) & ((n - gone < MIN_WORDS) | (gone > n * F.lit(MAX_REMOVED)))
    return (
        facts.drop("lines", "host")
        .join(removed, key, "left")
        .withColumn("n_removed_words", F.coalesce(gone, F.lit(0).cast("long")))
        .withColumn("base_failed", (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * n))
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
    )


def quality_digest(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """One row per document: base counts, ``base_failed``, ``kept`` and removed words."""
    rows = with_row_id(as_table(docs).select("doc_id", "text", F.col(host_col).alias("host_in")), "row_id")
    facts = saved(_facts(rows, "host_in", F.col("row_id"), F.col("doc_id")), "quality")
    return _verdicts(facts, "row_id", common_lines(facts)).drop("row_id")


def keep_good(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """The documents (all columns, text unchanged) that pass."""
    docs = as_table(docs)
    key = spare_name(docs, "row_id")
    rows = with_row_id(docs, key)
    facts = saved(_facts(rows, host_col, F.col(key).alias("row_id")), "quality")
    good = _verdicts(facts, "row_id", common_lines(facts)).where("kept").select(F.col("row_id").alias(key))
    return rows.join(good, key, "left_semi").drop(key)


def remove_common_lines(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """``docs`` with the common lines taken out of ``text``.

    The common lines that a document holds are gathered per document, so each
    row carries at most as many hashes as it has lines.
    """
    docs = as_table(docs)
    key = spare_name(docs, "row_id")
    rows = with_row_id(docs, key)
    facts = saved(_facts(rows, host_col, F.col(key).alias("row_id")), "quality")
    drop = spare_name(docs, "drop_keys")
    bad = (
        facts.select("row_id", "host", F.explode("lines").alias("line"))
        .select("row_id", "host", F.col("line.key").alias("key"))
        .join(common_lines(facts), ["host", "key"])
        .groupBy(F.col("row_id").alias(key))
        .agg(F.collect_set("key").alias(drop))
    )
    kept = F.filter(
        F.split(F.col("text"), "\n"),
        lambda x: F.col(drop).isNull() | ~F.coalesce(F.array_contains(F.col(drop), hash60(normalised(x))), F.lit(False)),
    )
    text = F.when(F.col(drop).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return rows.join(bad, key, "left").withColumn("text", text).drop(key, drop)
