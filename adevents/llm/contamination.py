"""Benchmark decontamination with a positional inverted index.

``build_index`` stores the postings of every training token: each task inverts
runs of whole documents (*segments* of about ``segment_bytes`` of text) and
writes one row per segment and term with the term's positions, sorted by term,
and one directory row per segment with its documents.  Positions count the
words of a segment and leave a gap of one between documents.

A test phrase is looked up segment by segment: phrases with a term that the
segment lacks are left out at once; for the others the shortest posting list
(of the term that is rarest there) gives the possible starts, which are
intersected with the other terms' lists, each moved by the term's offset, from
rare to common.  With ``slop`` above 0 a term may stand up to that many words
from its place: proximity matches.

Benchmark items are taken in chunks of at most ``chunk_words`` words; only such
a chunk (its terms and phrases) is ever collected or broadcast, and a larger
benchmark takes more chunks.  Postings reach a segment's task only for the
chunk's terms.

Cases: a null text has no words, an item without words never matches, one with
fewer words than the window is one phrase, a null ``item_id`` marks words but
isn't listed, repeated items count once per id, repeated rows are rows of
their own, empty tables give no rows or no hits, further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adevents.llm.common import as_table, saved, spare_name, with_row_id
from adevents.llm.words import ALNUM, Texts, same_ranges
from adevents.session import scratch_path

WINDOW = 10
SEGMENT_BYTES = 4 << 20
CHUNK_WORDS = 200_000
_INDEX = "segment long, term string, positions binary, row_ids array<long>, doc_ids array<long>, n_words array<int>"
_DOCS = "array<struct<start:int,end:int>>"
_MATCHES = f"row_id long, doc_id long, n_words int, hits {_DOCS}, items array<string>"


# ---- the index ---------------------------------------------------------------


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``most`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    run = (np.cumsum(sizes) - sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(run)) + 1), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(int(a), int(b - a))


def _segment(rows: pa.RecordBatch) -> pa.RecordBatch:
    texts = Texts(rows.column("text"), ALNUM, lower=True)
    position = (np.arange(len(texts.start)) + texts.text_of_word()).astype(np.int32)
    hashes = texts.hashes()
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    first = order[np.searchsorted(ranked, ranked)]
    size = texts.end - texts.start
    same = same_ranges(texts.data, texts.start[order], texts.end[order], texts.data, texts.start[first]) & (size[order] == size[first])
    if not same.all():  # different words of one hash: number the words themselves
        raw = texts.data.tobytes()
        words = [raw[a:b] for a, b in zip(texts.start.tolist(), texts.end.tolist())]
        numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
        hashes = np.array([numbers[w] for w in words], np.uint64)
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    edges = np.flatnonzero(new)
    example = order[edges]  # one place of each term
    raw = texts.data.tobytes()
    terms = pa.array(
        [raw[a:b] for a, b in zip(texts.start[example].tolist(), texts.end[example].tolist())], pa.binary()
    ).cast(pa.string())
    bounds = np.append(edges, len(order)).astype(np.int32) * 4
    positions = pa.BinaryArray.from_buffers(
        pa.binary(), len(edges), [None, pa.py_buffer(bounds), pa.py_buffer(position[order])]
    )
    by_term = pc.sort_indices(terms)
    n = len(edges)
    segment = rows.column("row_id")[0].as_py()
    one = lambda a, kind: pa.array([None] * n + [a], pa.list_(kind))
    return pa.record_batch(
        {
            "segment": pa.array([segment] * (n + 1), pa.int64()),
            "term": pa.concat_arrays([terms.take(by_term), pa.nulls(1, pa.string())]),
            "positions": pa.concat_arrays([positions.take(by_term), pa.nulls(1, pa.binary())]),
            "row_ids": one(rows.column("row_id").to_pylist(), pa.int64()),
            "doc_ids": one(rows.column("doc_id").cast(pa.int64()).to_pylist(), pa.int64()),
            "n_words": one(texts.n_words.tolist(), pa.int32()),
        }
    )


@dataclass(frozen=True)
class Index:
    """A stored index; ``path`` is below the shared checkpoint folder by default."""

    path: str

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_INDEX).parquet(self.path)


def build_index(docs: DataFrame, path: str | None = None, segment_bytes: int = SEGMENT_BYTES) -> Index:
    """Writes the postings of all words of ``docs`` (``doc_id, text``)."""

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _slices(batch, segment_bytes):
                yield _segment(rows)

    path = path or scratch_path(docs.sparkSession, "postings")
    with_row_id(as_table(docs).select("doc_id", "text"), "row_id").mapInArrow(invert, _INDEX).write.option(
        "compression", "zstd"
    ).parquet(path)
    return Index(path)


# ---- phrases -----------------------------------------------------------------


@dataclass(frozen=True)
class Phrases:
    """A chunk of test phrases: term numbers (-1 past the end), lengths and item numbers."""

    terms: list[str]
    phrases: np.ndarray
    lengths: np.ndarray
    items: np.ndarray
    item_ids: list[str | None]


def phrases_of(items: pa.Table, window: int) -> Phrases:
    texts = Texts(items.column("text"), ALNUM, lower=True)
    raw = texts.data.tobytes()
    words = [raw[a:b].decode("utf-8") for a, b in zip(texts.start.tolist(), texts.end.tolist())]
    terms = sorted(set(words))
    number = {t: i for i, t in enumerate(terms)}
    coded = np.array([number[w] for w in words], np.int32)
    rows, owners = [], []
    for i, (a, n) in enumerate(zip(texts.first, texts.n_words)):
        for s in range(max(n - window + 1, min(n, 1))):
            rows.append(np.pad(coded[a + s : a + min(s + window, n)], (0, max(0, window - n)), constant_values=-1))
            owners.append(i)
    table = np.array(rows, np.int32).reshape(-1, window)
    return Phrases(
        terms, table, (table >= 0).sum(1), np.array(owners, np.int64),
        [None if x is None else str(x) for x in items.column("item_id").to_pylist()],
    )


def _look_up(p: Phrases, lists: dict[int, np.ndarray], doc_start: np.ndarray, doc_end: np.ndarray, slop: int):
    """Yields ``(phrase, starts, documents)`` for the phrases that occur in a segment."""
    held = np.zeros(len(p.terms) + 1, bool)
    held[list(lists)] = True
    held[-1] = True  # the number -1, past a short phrase's end
    for row in np.flatnonzero(held[p.phrases].all(axis=1)):
        terms = p.phrases[row, : p.lengths[row]]
        by_rarity = sorted(range(len(terms)), key=lambda k: len(lists[terms[k]]))
        rarest = by_rarity[0]
        at = lists[terms[rarest]]
        start = at - rarest
        doc = np.searchsorted(doc_start, at, "right") - 1
        low, high = doc_start[doc], doc_end[doc]
        inside = (start >= low - slop) & (start + len(terms) <= high + slop)
        start, doc, low, high = start[inside], doc[inside], low[inside], high[inside]
        for k in by_rarity[1:]:
            if not len(start):
                break
            other = lists[terms[k]]
            found = np.searchsorted(other, np.maximum(start + k - slop, low))
            place = other[np.minimum(found, len(other) - 1)]
            inside = (found < len(other)) & (place <= np.minimum(start + k + slop, high - 1))
            start, doc, low, high = start[inside], doc[inside], low[inside], high[inside]
        if len(start):
            yield row, start, doc


def _match_segment(p: Phrases, slop: int, rows: pa.Table) -> pa.Table:
    number = {t: i for i, t in enumerate(p.terms)}
    is_directory = pc.is_null(rows.column("term"))
    directory = rows.filter(is_directory)
    row_ids, doc_ids, n_words = (directory.column(c)[0].as_py() for c in ("row_ids", "doc_ids", "n_words"))
    n = np.array(n_words, np.int64)
    doc_start = np.cumsum(n + 1) - (n + 1)
    doc_end = doc_start + n
    postings = rows.filter(pc.invert(is_directory))
    lists = {
        number[t]: np.frombuffer(x, np.int32).astype(np.int64)
        for t, x in zip(postings.column("term").to_pylist(), postings.column("positions").to_pylist())
    }
    edge = np.zeros(int(doc_end[-1]) + 2 if len(n) else 1, np.int32)
    found: dict[int, set[str]] = {}
    for row, start, doc in _look_up(p, lists, doc_start, doc_end, slop):
        np.add.at(edge, np.maximum(start, doc_start[doc]), 1)
        np.add.at(edge, np.minimum(start + p.lengths[row], doc_end[doc]), -1)
        item = p.item_ids[p.items[row]]
        for d in np.unique(doc).tolist():
            found.setdefault(d, set())
            if item is not None:
                found[d].add(item)
    hit = np.cumsum(edge) > 0
    spans: list[list[dict]] = [[] for _ in row_ids]
    for d in found:
        own = np.diff(np.concatenate([[0], hit[doc_start[d] : doc_end[d]].astype(np.int8), [0]]))
        spans[d] = [
            {"start": a, "end": b} for a, b in zip(np.flatnonzero(own == 1).tolist(), np.flatnonzero(own == -1).tolist())
        ]
    return pa.table(
        {
            "row_id": pa.array(row_ids, pa.int64()),
            "doc_id": pa.array(doc_ids, pa.int64()),
            "n_words": pa.array(n_words, pa.int32()),
            "hits": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            "items": pa.array([sorted(found.get(d, ())) for d in range(len(row_ids))], pa.list_(pa.string())),
        }
    )


def _matcher(phrases, slop: int):
    return lambda rows: _match_segment(phrases.value, slop, rows)


def _chunks(benchmark: DataFrame, most: int) -> Iterator[pa.Table]:
    """The items in runs of about ``most`` words; each run is collected by itself."""
    words = F.size(F.split(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+")).cast("long")
    sized = with_row_id(as_table(benchmark).select("item_id", "text"), "row_id").withColumn("words", words)
    total = sized.agg(F.sum("words")).first()[0]
    if total is None:
        return
    if total <= most:
        yield sized.toArrow()
        return
    # Items are dealt by hash into so many chunks that one has about ``most`` words.
    n = -(-total // most)
    dealt = saved(sized.withColumn("chunk", F.pmod(F.xxhash64("row_id"), F.lit(n))), "benchmark")
    for k in range(n):
        chunk = dealt.where(F.col("chunk") == k).toArrow()
        if chunk.num_rows:
            yield chunk


def find_matches(
    spark: SparkSession, index: Index, benchmark: DataFrame, window: int = WINDOW, slop: int = 0, chunk_words: int = CHUNK_WORDS
) -> DataFrame:
    """One row per indexed document: words hit (runs) and ids of the items found."""
    table = index.table(spark)
    results = []
    for chunk in _chunks(benchmark, chunk_words):
        phrases = phrases_of(chunk, window)
        terms = spark.createDataFrame([(t,) for t in phrases.terms], "term string")  # at most chunk_words rows
        directory = table.where(F.col("term").isNull())
        postings = table.where(F.col("term").isNotNull()).join(F.broadcast(terms), "term", "left_semi")
        match = _matcher(spark.sparkContext.broadcast(phrases), slop)
        results.append(directory.unionByName(postings).groupBy("segment").applyInArrow(match, _MATCHES))
    if not results:
        docs = table.where(F.col("term").isNull())
        zipped = docs.select(F.explode(F.arrays_zip("row_ids", "doc_ids", "n_words")).alias("d"))
        none = F.array()
        return zipped.select("d.row_ids", "d.doc_ids", "d.n_words").toDF("row_id", "doc_id", "n_words").withColumns(
            {"hits": none.cast(_DOCS), "items": none.cast("array<string>")}
        )
    if len(results) == 1:
        return results[0]
    merged = results[0]
    for more in results[1:]:
        merged = merged.unionByName(more)
    return merged.groupBy("row_id", "doc_id", "n_words").agg(
        F.sort_array(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    )


def n_hit_words(hits: Column) -> Column:
    """Words under a sorted array of runs that may overlap."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    step = lambda a, r: F.struct(
        (a["n"] + F.greatest(r["end"] - F.greatest(r["start"], a["upto"]), F.lit(0))).alias("n"),
        F.greatest(a["upto"], r["end"]).alias("upto"),
    )
    return F.aggregate(hits, zero, step, lambda a: a["n"].cast("long"))


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    found = find_matches(spark, build_index(docs), benchmark)
    items = F.sort_array("items")
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit_words(F.col("hits")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents (a table scan, all columns) without any benchmark phrase."""
    docs = as_table(docs)
    key = spare_name(docs, "row_id")
    bad = find_matches(docs.sparkSession, build_index(docs), benchmark).where(F.size("hits") > 0)
    return with_row_id(docs, key).join(bad.select(F.col("row_id").alias(key)), key, "left_anti").drop(key)
