"""Token files: ids ranked by frequency, in one to four bytes each, lengths apart from the bytes.

Format: Parquet files in ascending doc_id order, a row per block of documents.

- `doc_ids`, `sizes`: the documents of the block in order, and the ids of each;
- `ranks`: the ids of the block from the most to the least frequent, 32-bit little-endian, so that a block is read alone;
- `control`: two bits per id (bytes of its rank less one; four ids to a byte, the first in the lowest bits);
- `data`: the ranks' bytes, lowest first.

Ranks are counted over all ids of a block, so a single pass over the texts writes
the files, nothing is gathered on the driver, and a lost task is simply run again.

Null doc_ids come first, null texts count as empty, rows with equal doc_ids
follow each other, an empty table gives files without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonetally.llm.text import texts_only
from zonetally.llm.tokens import encoder, few_at_a_time

_FILE = "shard int, block int, doc_ids array<long>, sizes array<long>, ranks binary, control binary, data binary"
#: A block ends with the document that fills so many ids.
BLOCK_IDS = 1_000_000
#: Bytes of the four ids of a control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of the ranks."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[:len(ranks)] = extra
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    used = np.arange(4) <= extra[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n ranks; lengths come from a table by control byte."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    raw = np.zeros((n, 4), np.uint8)
    raw[np.arange(4) < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return raw.view("<u4").ravel()


def pack_block(ids: np.ndarray, size: int) -> tuple[bytes, bytes, bytes]:
    """The rank table, control and data bytes of the ids, all below `size`."""
    counts = np.bincount(ids, minlength=size)
    by_rank = np.argsort(-counts, kind="stable")[:np.count_nonzero(counts)]
    rank_of = np.zeros(size, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    return by_rank.astype("<u4").tobytes(), *pack_ranks(rank_of[ids])


def unpack_block(ranks: bytes, control: bytes, data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ranks, "<u4")[unpack_ranks(control, data, n)]


def write_ids(docs: DataFrame, path: str, tokenizer: str, keeps_space: bool = False, end: int = 1) -> None:
    """Encodes every whole text, appends `end`, and writes the files to `path` in doc_id order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, block, shard = encoder(tokenizer, keeps_space), 0, TaskContext.get().partitionId()
        keys: list = []
        held: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            ids = np.concatenate(held)
            values = [shard, block, keys, list(map(len, held)), *pack_block(ids, code.size)]
            types = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.binary()] * 3]
            names = ["shard", "block", "doc_ids", "sizes", "ranks", "control", "data"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

        for batch in batches:
            for some, texts in few_at_a_time(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys += some
                held += code.ids(texts, end)
                if sum(map(len, held)) >= BLOCK_IDS:
                    yield row()
                    keys, held, block = [], [], block + 1
        if keys:
            yield row()

    in_order = texts_only(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    in_order.mapInArrow(run, _FILE).write.parquet(path)


def _decoded(spark: SparkSession, path: str, kind: str, arrow: pa.DataType, column) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_block(row["ranks"], row["control"], row["data"], sum(row["sizes"]))
                of_docs = np.split(ids, np.cumsum(row["sizes"])[:-1])
                n = len(of_docs)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array([row["shard"]] * n, pa.int32()),
                    pa.array([row["block"] << 32 | k for k in range(n)], pa.int64()),
                    pa.array(row["sizes"], pa.int64()), pa.array([column(x) for x in of_docs], arrow),
                ], ["doc_id", "shard", "place", "n_tokens", "last"])

    files = spark.read.schema(_FILE).parquet(path)
    return files.mapInArrow(run, f"doc_id long, shard int, place long, n_tokens long, last {kind}")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, shard, place (order in the shard), n_tokens and `ids` of every document in the files."""
    return _decoded(spark, path, "array<long>", pa.list_(pa.int64()), lambda ids: ids).withColumnRenamed("last", "ids")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """As `read_ids`, with the crc32 of the ids (unsigned, little-endian 32-bit) in place of them."""
    def crc(ids: np.ndarray) -> int:
        return zlib.crc32(ids.astype("<u4").tobytes())

    return _decoded(spark, path, "long", pa.int64(), crc).withColumnRenamed("last", "ids_crc32")


def with_starts(read: DataFrame, path: str) -> DataFrame:
    """Adds `start`: the ids of all documents before. Sums run inside a shard; shards' totals, read from the sizes in
    the files alone, carry on."""
    sizes = F.aggregate("sizes", F.lit(0).cast("long"), lambda total, n: total + n)
    totals = read.sparkSession.read.schema(_FILE).parquet(path).groupBy("shard").agg(F.sum(sizes).alias("_total"))
    before = totals.select("shard", (F.sum("_total").over(Window.orderBy("shard")) - F.col("_total")).alias("_before"))
    inside = Window.partitionBy("shard").orderBy("place")
    return (read.withColumn("_inside", F.sum("n_tokens").over(inside) - F.col("n_tokens"))
            .join(before, "shard").withColumn("start", F.col("_before") + F.col("_inside")).drop("_before", "_inside"))
