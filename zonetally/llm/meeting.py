"""Two tables that meet in bins: rows of one are held, rows of the other stream past them.

A join would repeat the held columns in every row it makes. Here both tables are
dealt to the same partitions by `bin` and sorted so that a bin's held rows come
first; a task keeps those of one bin at a time. Memory is that of a bin's held
rows and one Arrow batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonetally.llm.text import forget, released


def each_bin(df: DataFrame, bins: int) -> DataFrame:
    """Every row once per bin, in column `bin`."""
    return df.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))


def one_bin(df: DataFrame, bins: int, *by: str | Column) -> DataFrame:
    """Every row in one bin, by the hash of `by`."""
    return df.withColumn("bin", F.pmod(F.xxhash64(*by), F.lit(bins)).cast("int"))


def meet(held: DataFrame, streamed: DataFrame, keep: Callable[[list[dict]], object],
         fn: Callable[[object, pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """fn(keep(held rows of the bin), batch of the bin's streamed rows), for every bin that has both.

    Both tables have a column `bin` of the same type. The batch has the other columns of `streamed`; the held
    rows come as dicts.
    """
    one, two = [c for c in held.columns if c != "bin"], [c for c in streamed.columns if c != "bin"]
    first = held.select("bin", F.lit(0).alias("side"), F.struct(*one).alias("held"), F.lit(None).cast(streamed.select(F.struct(*two)).schema[0].dataType).alias("streamed"))
    second = streamed.select("bin", F.lit(1).alias("side"), F.lit(None).cast(first.schema["held"].dataType).alias("held"), F.struct(*two).alias("streamed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        now, rows, state = None, [], None
        for batch in batches:
            bins, sides = batch["bin"].to_pylist(), batch["side"].to_pylist()
            start = 0
            while start < len(bins):
                end = start + 1
                while end < len(bins) and bins[end] == bins[start] and sides[end] == sides[start]:
                    end += 1
                if bins[start] != now:
                    now, rows, state = bins[start], [], None
                part = batch.slice(start, end - start)
                if sides[start] == 0:
                    rows += part["held"].to_pylist()
                elif rows:
                    if state is None:
                        state = keep(rows)
                        rows = [None]  # the state stands for them
                    yield from fn(state, pa.RecordBatch.from_struct_array(part["streamed"]))
                start = end

    return first.union(second).repartition("bin").sortWithinPartitions("bin", "side").mapInArrow(released(run), schema)
