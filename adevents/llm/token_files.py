"""Token ids of a corpus in a compact file format, and back.

The corpus is range-partitioned by ``doc_id``; every partition (a *part*)
tokenizes its documents in order, appends the end id to each, cuts the part's
ids into blocks of ``range_coder.BLOCK_IDS`` and codes them.  A file row holds up
to ``range_coder.LANES`` blocks: part, position of its first id in the part, the
shares of its ids (the coder's order 0), and of each block its position in the
part, number of ids, crc32 of the ids as little-endian unsigned 32-bit integers,
code, and the documents (or pieces of documents) in it.  Parts are Parquet files,
so they are committed atomically by Spark, can be split between tasks and be read
in any order; blocks are decoded independently of each other, with their row's
shares, and checked against their crc32.

Cases: a null text is empty (its end id alone), a null ``doc_id`` sorts first,
repeated ids are ordered by text, an empty corpus gives an empty file, further
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adevents.llm import range_coder, tokens
from adevents.llm.contamination import _slices as slices_of
from adevents.session import scratch_path

_PIECES = "array<struct<nth:long,doc_id:long,at:int>>"
_BLOCKS = f"array<struct<first:long,n:int,crc32:long,code:binary,pieces:{_PIECES}>>"
FILE = f"part int, first long, n long, shares binary, blocks {_BLOCKS}"
_PIECE_TYPE = pa.list_(pa.struct([("nth", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int32())]))
#: A file row takes some megabytes, so row groups are kept small.
ROW_GROUP_BYTES = 32 << 20
#: Bytes of text tokenized at once; the arrays for them take some thirty times as much.
SLICE_BYTES = 1 << 20


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


class _Writer:
    """Turns a part's stream of documents into file rows."""

    def __init__(self, part: int):
        self.part, self.first, self.nth = part, 0, 0
        self.ids: list[np.ndarray] = []
        self.held = 0
        self.doc_start: list[np.ndarray] = []
        self.doc_ids: list = []
        self.doc_first = 0  # number of the first document in doc_ids

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> None:
        counts = counts + 1
        upto = np.cumsum(counts)
        full = np.full(int(upto[-1]), tokens.END_ID, np.uint16)
        keep = np.ones(len(full), bool)
        keep[upto - 1] = False
        full[keep] = ids
        self.doc_start.append(self.first + self.held + upto - counts)
        self.doc_ids.extend(doc_ids)
        self.ids.append(full)
        self.held += len(full)

    def rows(self, everything: bool) -> Iterator[pa.RecordBatch]:
        size, batch = range_coder.BLOCK_IDS, range_coder.BLOCK_IDS * range_coder.LANES
        if self.held < batch and not (everything and self.held):
            return
        stream = np.concatenate(self.ids)
        starts = np.concatenate(self.doc_start)
        at = 0
        while len(stream) - at >= batch or (everything and at < len(stream)):
            end = min(at + batch, len(stream))
            yield self._coded([stream[a : min(a + size, end)] for a in range(at, end, size)], self.first + at, starts)
            at = end
        self.first += at
        self.ids, self.held = [stream[at:]], len(stream) - at
        done = max(int(np.searchsorted(starts, self.first, "right")) - 1, 0)  # documents that end before
        self.doc_start, self.doc_ids, self.doc_first = [starts[done:]], self.doc_ids[done:], self.doc_first + done

    def _coded(self, blocks: list[np.ndarray], first: int, starts: np.ndarray) -> pa.RecordBatch:
        sizes = np.array([len(b) for b in blocks])
        firsts = first + np.cumsum(sizes) - sizes
        # A block's pieces: the document that goes on from before, and those that begin in it.
        begin = np.searchsorted(starts, firsts, "right") - 1
        end = np.searchsorted(starts, firsts + sizes, "left")
        pieces = [
            [
                {"nth": self.doc_first + d, "doc_id": self.doc_ids[d], "at": max(int(starts[d]) - int(f), 0)}
                for d in range(b, e)
            ]
            for b, e, f in zip(begin.tolist(), end.tolist(), firsts.tolist())
        ]
        shares = range_coder.Shares.of(np.concatenate(blocks))
        columns = {
            "first": pa.array(firsts, pa.int64()),
            "n": pa.array(sizes, pa.int32()),
            "crc32": pa.array([_crc(b) for b in blocks], pa.int64()),
            "code": pa.array(range_coder.encode_blocks(blocks, shares), pa.binary()),
            "pieces": pa.array(pieces, _PIECE_TYPE),
        }
        coded = pa.StructArray.from_arrays(list(columns.values()), list(columns))
        return pa.record_batch(
            {
                "part": pa.array([self.part], pa.int32()),
                "first": pa.array([first], pa.int64()),
                "n": pa.array([int(sizes.sum())], pa.int64()),
                "shares": pa.array([shares.written()], pa.binary()),
                "blocks": pa.ListArray.from_arrays(pa.array([0, len(blocks)], pa.int32()), coded),
            }
        )


def write_tokens(docs: DataFrame, path: str | None = None, tokenizer: str | None = None) -> str:
    """Writes ``docs`` (``doc_id, text``) as coded ids; gives the path (a new one below the checkpoint folder)."""
    path = path or scratch_path(docs.sparkSession, "tokens")
    tokenizer = tokenizer or tokens.tokenizer_path()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            for rows in slices_of(batch, SLICE_BYTES):
                writer = writer or _Writer(rows.column("part")[0].as_py())
                writer.add(rows.column("doc_id").to_pylist(), *tokens.encode(rows.column("text"), tokenizer))
                yield from writer.rows(everything=False)
        if writer:
            yield from writer.rows(everything=True)

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    ordered.mapInArrow(code, FILE).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return path


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE).parquet(path)


def _decoded(row: pa.RecordBatch):
    """A file row's blocks: their ids (checked), positions and pieces."""
    first, n, crc32, code, pieces = row.column("blocks").flatten().flatten()
    shares = range_coder.Shares.read(row.column("shares")[0].as_py())
    out = range_coder.decode_blocks(code.to_pylist(), n.to_pylist(), shares)
    for ids, crc in zip(out, crc32.to_pylist()):
        if _crc(ids) != crc:
            raise ValueError("a block of token ids doesn't match its checksum")
    return zip(out, first.to_pylist(), pieces.to_pylist())


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """``part, nth, doc_id, first, ids``: the ids of every piece of a document, in file blocks."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, *columns in _with_pieces(batches):
            part, first, nth, doc_id, ids = columns
            yield pa.record_batch(
                [
                    pa.array(part, pa.int32()),
                    pa.array(nth, pa.int64()),
                    pa.array(doc_id, pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(ids, pa.list_(pa.int32())),
                ],
                names=["part", "nth", "doc_id", "first", "ids"],
            )

    return read_blocks(spark, path).mapInArrow(pieces, "part int, nth long, doc_id long, first long, ids array<int>")


def _with_pieces(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            part, first, nth, doc_id, ids = [], [], [], [], []
            p = row.column("part")[0].as_py()
            for block, f, pieces in _decoded(row):
                cuts = [x["at"] for x in pieces] + [len(block)]
                for x, a, b in zip(pieces, cuts, cuts[1:]):
                    part.append(p)
                    first.append(f + a)
                    nth.append(x["nth"])
                    doc_id.append(x["doc_id"])
                    ids.append(block[a:b])
            yield row, part, first, nth, doc_id, ids


# ---- crc32 of a whole from the crc32s of its pieces ---------------------------

_POLY = 0xEDB88320
_POWER: dict[int, int] = {0: 1 << 31}


def _times(a: int, b: int) -> int:
    """The product of two polynomials modulo crc32's (bit 31 is the constant term)."""
    out = 0
    for i in range(31, -1, -1):
        if a >> i & 1:
            out ^= b
        b = (b >> 1) ^ _POLY if b & 1 else b >> 1
    return out


def _shift_by(n_bytes: int) -> int:
    """x to the power of 8 * n_bytes."""
    if n_bytes not in _POWER:
        half = _shift_by(n_bytes // 2)
        out = _times(half, half)
        _POWER[n_bytes] = _times(out, 1 << 23) if n_bytes % 2 else out
    return _POWER[n_bytes]


def joined_crc32(pieces: list[tuple[int, int]]) -> int:
    """The crc32 of bytes from ``(crc32, number of bytes)`` of their pieces in order."""
    crc = pieces[0][0] if pieces else 0
    for more, n in pieces[1:]:
        crc = _times(_shift_by(n), crc) ^ more
    return crc


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone."""

    def crcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part, first, nth, doc_id, ids in _with_pieces(batches):
            yield pa.record_batch(
                [
                    pa.array(part, pa.int32()),
                    pa.array(nth, pa.int64()),
                    pa.array(doc_id, pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([_crc(x) for x in ids], pa.int64()),
                ],
                names=["part", "nth", "doc_id", "first", "n", "crc"],
            )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            joined = [joined_crc32([(p["crc"], 4 * p["n"]) for p in x]) for x in batch.column("pieces").to_pylist()]
            kept = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.record_batch([*kept, pa.array(joined, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    blocks = read_blocks(spark, path)
    pieces = blocks.mapInArrow(crcs, "part int, nth long, doc_id long, first long, n long, crc long")
    docs = pieces.groupBy("part", "nth").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("first").alias("first"),
        F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("first", "n", "crc"))).alias("pieces"),
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (  # one row per part
        blocks.groupBy("part").agg(F.sum("n").alias("ids")).select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    )
    rows = docs.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "pieces"
    )
    return rows.mapInArrow(whole, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digest(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    return read_digest(docs.sparkSession, write_tokens(docs, tokenizer=tokenizer))
