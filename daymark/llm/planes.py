"""Token ids as files of compressed bit or byte planes.

A segment holds the ids of some whole documents, one after the other:

    4 bytes   b"IDPL"
    u8 u8 u16 bytes per id (2 or 4), planes per id, 0
    u32 u32   ids in a block, number of blocks
    u64 u32   number of ids, number of documents
    u32       size of the document table, which follows: zstandard over the
              documents' ids (i64), null marks (u8) and lengths (u64)
    u32 ...   the chunk index: the size of each plane of each block
    ...       the planes, each compressed by zstandard

All numbers are little-endian. A block of ids is transposed, so that the same
bit (or byte) of all its ids lies together. Segments are the rows of a Parquet
table, written by Spark's committer: a task that runs again leaves no half
file, and any store that Spark reaches will do.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymark.llm.tasks import map_batches
from daymark.llm.text import slices
from daymark.llm.tokens import SLICE_BYTES, encoder, with_end

HEAD = struct.Struct("<4sBBHIIQII")
MAGIC = b"IDPL"
BLOCK = 1 << 16


def _planes(block: np.ndarray, bits: bool) -> np.ndarray:
    raw = block.view(np.uint8).reshape(len(block), -1)
    return np.packbits(np.unpackbits(raw, axis=1).T, axis=1) if bits else np.ascontiguousarray(raw.T)


def _block(planes: np.ndarray, n: int, dtype: np.dtype, bits: bool) -> np.ndarray:
    raw = np.packbits(np.unpackbits(planes, axis=1)[:, :n].T, axis=1) if bits else planes.T
    return np.ascontiguousarray(raw).reshape(-1).view(dtype)


def write_segment(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, bits: bool = False) -> bytes:
    """``ids`` is unsigned, of 16 or 32 bits."""
    ids = ids.astype(ids.dtype.newbyteorder("<"), copy=False)
    press = zstandard.ZstdCompressor(level=3)
    chunks = [
        press.compress(plane.tobytes())
        for low in range(0, len(ids), BLOCK)
        for plane in _planes(ids[low : low + BLOCK], bits)
    ]
    width = ids.dtype.itemsize
    table = press.compress(
        np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes()
        + np.array([x is None for x in doc_ids], dtype=np.uint8).tobytes()
        + lengths.astype("<u8").tobytes()
    )
    head = HEAD.pack(
        MAGIC, width, width * 8 if bits else width, 0, BLOCK, -(-len(ids) // BLOCK), len(ids), len(doc_ids), len(table)
    )
    index = np.array([len(c) for c in chunks], dtype="<u4").tobytes()
    return b"".join([head, table, index, *chunks])


def read_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, lengths and all ids of a segment."""
    magic, width, planes, _, size, blocks, n_ids, n_docs, table_size = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a segment of id planes")
    expand = zstandard.ZstdDecompressor()
    table = expand.decompress(data[HEAD.size : HEAD.size + table_size])
    numbers = np.frombuffer(table, "<i8", n_docs).tolist()
    absent = np.frombuffer(table, np.uint8, n_docs, 8 * n_docs)
    lengths = np.frombuffer(table, "<u8", n_docs, 9 * n_docs).astype(np.int64)
    at = HEAD.size + table_size
    sizes = np.frombuffer(data, "<u4", blocks * planes, at).tolist()
    at += 4 * blocks * planes
    dtype, bits, parts = np.dtype(f"<u{width}"), planes != width, []
    for b in range(blocks):
        n = min(size, n_ids - b * size)
        block = []
        for length in sizes[b * planes : (b + 1) * planes]:
            block.append(np.frombuffer(expand.decompress(data[at : at + length]), np.uint8))
            at += length
        parts.append(_block(np.stack(block), n, dtype, bits))
    ids = np.concatenate(parts) if parts else np.zeros(0, dtype)
    return [None if a else x for x, a in zip(numbers, absent, strict=True)], lengths, ids


def _write(path: str, end: int, bits: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, segment, encode = TaskContext.get().partitionId(), 0, encoder(path)
        for batch in batches:
            for low, high in slices(batch.column(1), SLICE_BYTES):
                ids, offsets = with_end(*encode.encode(batch.column(1)[low:high]), end)
                data = write_segment(batch.column(0)[low:high].to_pylist(), np.diff(offsets), ids, bits)
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([shard], pa.int64()),
                        "segment": pa.array([segment], pa.int64()),
                        "n_ids": pa.array([len(ids)], pa.int64()),
                        "data": pa.array([data], pa.binary()),
                    }
                )
                segment += 1

    return run


def write_ids(
    docs: DataFrame,
    target: str,
    tokenizer: str,
    end: int = 0,
    bits: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encode all texts, ``end`` after each, and write them in ascending order of ids to ``target``.

    A null or empty text is the id ``end`` alone. Rows with a null id come
    first, rows with equal ids in the order of their texts. Other columns are
    not read. An empty table writes an empty one.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    segments = map_batches(
        ordered, _write(tokenizer, end, bits), "shard long, segment long, n_ids long, data binary"
    )
    segments.write.option("compression", "none").parquet(target)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, segment, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            doc_ids, lengths, ids = read_segment(data)
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            n = len(doc_ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, shard)),
                    pa.array(np.full(n, segment)),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(offsets[:-1]),
                    pa.Array.from_buffers(
                        pa.large_binary(), n, [None, pa.py_buffer(offsets * 4), pa.py_buffer(ids.astype("<u4"))]
                    ).cast(pa.binary()),
                ],
                names=["shard", "segment", "doc_id", "place", "ids"],
            )


def read_ids(spark: SparkSession, target: str) -> DataFrame:
    """What ``write_ids`` wrote: shard, segment, doc_id, place in the segment, ids (u32 little-endian)."""
    segments = spark.read.parquet(target).select("shard", "segment", "data")
    return map_batches(segments, _read, "shard long, segment long, doc_id long, place long, ids binary")


def segment_starts(spark: SparkSession, target: str) -> DataFrame:
    """shard, segment, and the number of ids in all segments before it.

    Running totals inside each shard, then over the shards, of which there are
    as many as tasks wrote.
    """
    segments = spark.read.parquet(target).select("shard", "segment", "n_ids")

    def before(order: str, *keys: str) -> F.Column:
        rows = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n_ids").over(rows), F.lit(0))

    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    shards = shards.select("shard", before("shard").alias("_shard_start"))
    inside = segments.select("shard", "segment", before("segment", "shard").alias("_inside"))
    return inside.join(shards, "shard").select(
        "shard", "segment", (F.col("_shard_start") + F.col("_inside")).alias("segment_start")
    )
