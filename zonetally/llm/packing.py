"""Packing by shortest-pack-first over the histogram of piece lengths.

Documents are tokenized once and cut into pieces of at most the sequence
length. Only the histogram of lengths (one number per length) reaches the
driver: lengths are placed longest first, each time onto the emptiest packing
pattern with room, whose count is split or moved. Pieces then find their place
by rank: the k-th piece of a length takes the k-th slot of that length.

A piece's rank is its rank in the task that wrote it plus the pieces of its
length in earlier tasks, so no task orders all pieces of a frequent length.
Null texts count as empty (one piece with the end id), null doc_ids stay, equal
rows are packed each, an empty table gives no pieces.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonetally.llm.text import released, texts_only
from zonetally.llm.tokens import encoder, few_at_a_time
from zonetally.session import scratch_path

_PIECES = "doc_id long, start long, length int, ids binary, doc_tokens long, task int, place long"
#: Rows of a table of (length, task) counts up to which it is broadcast; larger ones are joined by shuffle.
MOST_BROADCAST = 200_000


def cut(docs: DataFrame, tokenizer: str, keeps_space: bool, length: int, end: int) -> DataFrame:
    """The pieces of all documents with their ids (little-endian, 32 bits each), stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, task = encoder(tokenizer, keeps_space), TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for batch in batches:
            for keys, texts in few_at_a_time(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                for key, ids in zip(keys, code.ids(texts, end), strict=True):
                    raw = ids.astype("<u4").tobytes()
                    for start in range(0, len(ids), length):
                        n = min(length, len(ids) - start)
                        rows.append((key, start, n, raw[4 * start:4 * (start + n)], len(ids), task, seen[n]))
                        seen[n] += 1
                types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]
                names = ["doc_id", "start", "length", "ids", "doc_tokens", "task", "place"]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    path = scratch_path(docs.sparkSession, "pieces")
    texts_only(docs).mapInArrow(released(run), _PIECES).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(_PIECES).parquet(path)


def patterns(histogram: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packing patterns as (how many sequences, [(length, times in each)]).

    A heap holds groups of equal packs by their free room. The emptiest group with room takes the length; if fewer
    pieces are left than it has packs, it is split.
    """
    groups: list[tuple[int, int, int, tuple]] = []  # (-room, tie, packs, pattern), a linked list from the last length
    tie = 0
    for length in sorted((n for n in histogram if histogram[n]), reverse=True):
        left = histogram[length]
        while left:
            if groups and -groups[0][0] >= length:
                room, _, packs, pattern = heapq.heappop(groups)
                if packs > left:
                    heapq.heappush(groups, (room, tie, packs - left, pattern))
                    packs, tie = left, tie + 1
                heapq.heappush(groups, (room + length, tie, packs, (length, pattern)))
            else:
                packs = left
                heapq.heappush(groups, (length - size, tie, packs, (length, ())))
            left, tie = left - packs, tie + 1
    out = []
    for _, _, packs, pattern in groups:
        times: dict[int, int] = defaultdict(int)
        while pattern:
            times[pattern[0]] += 1
            pattern = pattern[1]
        out.append((packs, sorted(times.items(), reverse=True)))
    return out


def slots(found: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, list[int]]:
    """By length, the ranks that a pattern's sequences take: [rank_from, rank_to), `times` in each sequence."""
    taken: dict[int, int] = defaultdict(int)
    out: dict[str, list[int]] = {k: [] for k in ("length", "rank_from", "rank_to", "times", "first_sequence", "at")}
    sequence = 0
    for packs, parts in found:
        at = 0
        for length, times in parts:
            values = (length, taken[length], taken[length] + packs * times, times, sequence, at)
            for column, value in zip(out.values(), values, strict=True):
                column.append(value)
            taken[length] += packs * times
            at += length * times
        sequence += packs
    return out


def pack(docs: DataFrame, tokenizer: str, keeps_space: bool = True, length: int = 2048, end: int = 1) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset of every piece; sequences hold `length` ids at most."""
    spark = docs.sparkSession
    pieces = cut(docs, tokenizer, keeps_space, length, end)
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    histogram = {row.length: row.n for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    found = slots(patterns(histogram, length))
    # by construction at most a few rows per length and pattern, however many documents there are
    table = spark.createDataFrame(pa.table({k: pa.array(v, pa.int64()) for k, v in found.items()}))
    table = table.select(F.col("length").cast("int").alias("length"), "rank_from", "rank_to", "times", "first_sequence", "at")

    earlier = Window.partitionBy("length").orderBy("task")
    offsets = by_task.select("length", "task", (F.sum("n").over(earlier) - F.col("n")).alias("before"))
    if len(histogram) * pieces.select("task").distinct().count() <= MOST_BROADCAST:
        offsets = F.broadcast(offsets)
    ranked = pieces.join(offsets, ["length", "task"]).withColumn("rank", F.col("before") + F.col("place"))
    table = F.broadcast(table.withColumnRenamed("length", "slot_length"))
    hit = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    step = F.col("rank") - F.col("rank_from")
    return ranked.join(table, hit).select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids", "doc_tokens",
        (F.col("first_sequence") + F.floor(step / F.col("times"))).cast("long").alias("sequence_id"),
        (F.col("at") + step % F.col("times") * F.col("length")).cast("long").alias("offset"))
