"""Questions that blocks of documents put to hash partitions of a key space.

Counting the words, n-grams or windows of a corpus by shuffling one row per
occurrence costs far more than the texts.  Here the documents are dealt into
*blocks* (compressed Arrow record batches, shuffled once; Spark reuses that
exchange), a block sends each hash partition one row with its distinct keys in
sorted, delta-coded form, the partition answers all blocks' rows together, and
the answers go back to their blocks, which hold the texts.  A key that is in a
third of all documents costs one entry per block; no key's occurrences meet in
one task, and nothing passes through the driver.

Blocks are dealt by a hash of the row's number, so neither a hot source nor a
repeated row makes a block large, and a recomputed block (after a lost
executor) holds the same rows in the same order; a block whose answers don't
fit its keys raises.  The numbers of blocks and of key partitions follow the
bytes of the texts alone (:func:`layout_of`): both grow as their square root,
so that a message from a block to a partition stands for the same amount of
text at any size, and the number of messages grows as the texts do.
"""

from __future__ import annotations

import io
import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adevents.llm.common import with_row_id

#: Blocks per key partition, and blocks per task.  Every block sends a row to every key partition.
BLOCKS = 4
TASK_BLOCKS = 2
MIN_PARTS = 2
#: Bytes of text that a message stands for.
MESSAGE_BYTES = 32 << 10
ANSWER = "block int, round int, part int, payload binary"
_ANSWER = pa.schema([("block", pa.int32()), ("round", pa.int32()), ("part", pa.int32()), ("payload", pa.binary())])
_PACKED = "block int, payload binary"


# ---- arrays as bytes ---------------------------------------------------------


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: each one's bytes are turned into planes, then compressed."""
    out = io.BytesIO()
    for a in arrays:
        a = np.ascontiguousarray(a)
        out.write(np.array([ord(a.dtype.kind), a.dtype.itemsize, a.size], "<i8").tobytes())
        out.write(a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes())
    raw = out.getvalue()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack_arrays(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 0
    while at < len(raw):
        kind, width, n = np.frombuffer(raw, "<i8", 3, at)
        at += 24
        planes = np.frombuffer(raw, np.uint8, int(n * width), at).reshape(int(width), int(n))
        out.append(np.ascontiguousarray(planes.T).view(f"{chr(kind)}{width}").reshape(-1))
        at += int(n * width)
    return out


def gaps(sorted_keys: np.ndarray) -> np.ndarray:
    """Differences of an ascending array (undone by :func:`ungap`)."""
    out = sorted_keys.copy()
    out[1:] -= sorted_keys[:-1]
    return out


def ungap(differences: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumsum(differences, dtype=differences.dtype)


def cuts_of(sorted_keys: np.ndarray, parts: int, bits: int = 64) -> np.ndarray:
    """Where the parts of a sorted array of ``bits``-bit keys begin (parts + 1 entries)."""
    bounds = [(p << bits) // parts for p in range(1, parts)]
    inner = np.searchsorted(sorted_keys, np.array(bounds, np.uint64))
    return np.concatenate([[0], inner, [len(sorted_keys)]]).astype(np.int64)


def bits_of(flags: np.ndarray) -> np.ndarray:
    return np.packbits(flags)


def flags_of(bits: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(bits, count=n).astype(bool)


# ---- blocks ------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Numbers of blocks and of hash partitions of the keys, for so many bytes of texts."""

    blocks: int
    parts: int
    size: int

    @property
    def tasks(self) -> int:
        return max(1, self.blocks // TASK_BLOCKS)

    def block_of(self, row_id: str) -> Column:
        return F.pmod(F.xxhash64(row_id), F.lit(self.blocks)).cast("int")


def layout_of(docs: DataFrame, column: str = "text") -> Layout:
    size = docs.agg(F.sum(F.octet_length(column).cast("long"))).first()[0] or 0
    parts = max(MIN_PARTS, math.isqrt(size // (BLOCKS * MESSAGE_BYTES)))
    return Layout(BLOCKS * parts, parts, size)


def _pack_batches(columns: list[str]):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
        for batch in batches:
            if not batch.num_rows:
                continue
            block = batch.column("block").to_numpy(zero_copy_only=False)
            order = np.argsort(block, kind="stable")
            edges = np.flatnonzero(np.diff(block[order])) + 1
            rows = pa.Table.from_batches([batch]).select(columns)
            ids, payloads = [], []
            for chosen in np.split(order, edges):
                sink = pa.BufferOutputStream()
                part = rows.take(pa.array(chosen)).combine_chunks()
                with pa.ipc.new_stream(sink, part.schema, options=options) as writer:
                    writer.write_table(part)
                ids.append(int(block[chosen[0]]))
                payloads.append(sink.getvalue().to_pybytes())
            yield pa.record_batch({"block": pa.array(ids, pa.int32()), "payload": pa.array(payloads, pa.binary())})

    return pack


def deal(docs: DataFrame, layout: Layout, *columns: str) -> DataFrame:
    """``docs`` (a table scan) as blocks of ``row_id`` and the given columns."""
    rows = with_row_id(docs.select(*columns), "row_id").withColumn("block", layout.block_of("row_id"))
    return rows.mapInArrow(_pack_batches(["row_id", *columns]), _PACKED).repartition(layout.tasks, "block")


def _rows_of(block: pa.Table) -> pa.Table:
    """A block's documents, in the order of the table."""
    tables = [pa.ipc.open_stream(p.as_buffer()).read_all() for p in block.column("payload").combine_chunks()]
    tables.sort(key=lambda t: t.column("row_id")[0].as_py())
    return pa.concat_tables(tables)


def answer_table(block: int | pa.Array, number: int, parts: list, payloads: list[bytes]) -> pa.Table:
    n = len(payloads)
    blocks = pa.array([block] * n, pa.int32()) if isinstance(block, int) else block
    return pa.table([blocks, pa.array([number] * n, pa.int32()), pa.array(parts, pa.int32()), pa.array(payloads, pa.binary())], schema=_ANSWER)


def questions(blocks: DataFrame, number: int, ask: Callable, answers: DataFrame | None = None) -> DataFrame:
    """Round ``number``'s questions: ``ask(rows, earlier)`` gives one payload per part.

    ``earlier`` maps a round to its answers, one payload per part.
    """

    def one_block(key, block):
        payloads = ask(_rows_of(block), {})
        return answer_table(key[0].as_py(), number, list(range(len(payloads))), payloads)

    def with_answers(key, block, replies):
        payloads = ask(_rows_of(block), by_round(replies))
        return answer_table(key[0].as_py(), number, list(range(len(payloads))), payloads)

    if answers is None:
        return blocks.groupBy("block").applyInArrow(one_block, ANSWER)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(with_answers, ANSWER)


def by_round(replies: pa.Table) -> dict[int, list[bytes]]:
    replies = replies.sort_by([("round", "ascending"), ("part", "ascending")])
    out: dict[int, list[bytes]] = {}
    for number, payload in zip(replies.column("round").to_pylist(), replies.column("payload").to_pylist()):
        out.setdefault(number, []).append(payload)
    return out


def answered(asked: DataFrame, reply: Callable[[list[bytes]], Iterable[bytes]], layout: Layout) -> DataFrame:
    """Every part answers all its blocks' questions: ``reply(payloads)``, in the same order."""

    def one_part(key, rows):
        rows = rows.sort_by([("round", "ascending"), ("block", "ascending")])
        replies = list(reply(rows.column("payload").to_pylist()))
        return answer_table(rows.column("block").combine_chunks(), rows.column("round")[0].as_py(), rows.column("part").to_pylist(), replies)

    return asked.repartition(layout.parts, "part").groupBy("part").applyInArrow(one_part, ANSWER)


def finish(blocks: DataFrame, answers: DataFrame, schema: str, use: Callable) -> DataFrame:
    """``use(rows, answers by round)`` gives the result table of each block."""

    def one_block(block, replies):
        return use(_rows_of(block), by_round(replies))

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(one_block, schema)
