"""Running sums, maxima and predecessors over groups of any size.

A plain window puts a whole group into one task. Here the rows are dealt out by
ranges of (group, order) first: borders come from Spark's sample of the rows, so
ranges have about as many rows each, whether a group is spread over time or has all
its rows in one second. A range is a chunk. The window runs inside (group, chunk), and a
window over one summary row per group and chunk carries the value from chunk to chunk.

Chunks follow one another, so only the first group of a chunk can have rows before it: the
carried values are no more than the chunks, however many groups and rows there are. That
bounds what the carry step sees of any group, and what is broadcast.

Null groups are groups. `order` should tell rows apart; equal ones stand in any order. A caller whose
groups are cut already may name a chunk column, which must not decrease along `order`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonetally.session import store

CHUNK = "_chunk"


def time_chunk(seconds: Column | str, width: float = 3600.0) -> Column:
    c = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.floor(c / F.lit(float(width)))


def _chunked(df: DataFrame, groups: list[str], order: list[str], chunk: Column | None) -> DataFrame:
    """The rows with their chunk. Ranges are stored: dealt out anew, rows could fall to other ranges."""
    if chunk is not None:
        return df.withColumn(CHUNK, chunk)
    dealt = df.repartitionByRange(*groups, *order).withColumn(CHUNK, F.spark_partition_id().cast("bigint"))
    return store(df.sparkSession, dealt, "ranges")


def _local(groups: list[str], order: list[str]):
    return Window.partitionBy(*groups, CHUNK).orderBy(*order)


def _chunks(groups: list[str]):
    return Window.partitionBy(*groups).orderBy(CHUNK)


def _with_carry(df: DataFrame, summary: DataFrame, groups: list[str], carried: list[str], bounded: bool) -> DataFrame:
    """Adds what `summary` carries into each chunk; groups that begin in a chunk have no row in it."""
    keys = [*groups, CHUNK]
    some = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in carried])
    renamed = summary.where(some).select(*[F.col(k).alias(f"_of_{n}") for n, k in enumerate(keys)], *carried)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{n}")) for n, k in enumerate(keys)])
    # one row per chunk at most, if the chunks are ranges
    return df.join(F.broadcast(renamed) if bounded else renamed, same, "left").drop(*[f"_of_{n}" for n in range(len(keys))])


def running_sum(df: DataFrame, groups: list[str], order: list[str], value: Column, out: str, chunk: Column | None = None) -> DataFrame:
    """Sum of `value` from the group's first row to this one."""
    df = _chunked(df.withColumn("_v", value), groups, order, chunk)
    before = _chunks(groups).rowsBetween(Window.unboundedPreceding, -1)
    carry = df.groupBy(*groups, CHUNK).agg(F.sum("_v").alias("_sum")).select(*groups, CHUNK, F.sum("_sum").over(before).alias("_carry"))
    inside = df.withColumn("_in", F.sum("_v").over(_local(groups, order).rowsBetween(Window.unboundedPreceding, 0)))
    return (
        _with_carry(inside, carry, groups, ["_carry"], chunk is None)
        .withColumn(out, F.coalesce("_carry", F.lit(0)) + F.col("_in"))
        .drop(CHUNK, "_v", "_in", "_carry")
    )


def running_max(df: DataFrame, groups: list[str], order: list[str], value: Column, out: str, chunk: Column | None = None) -> DataFrame:
    """Largest `value` from the group's first row to this one."""
    df = _chunked(df.withColumn("_v", value), groups, order, chunk)
    before = _chunks(groups).rowsBetween(Window.unboundedPreceding, -1)
    carry = df.groupBy(*groups, CHUNK).agg(F.max("_v").alias("_max")).select(*groups, CHUNK, F.max("_max").over(before).alias("_carry"))
    inside = df.withColumn("_in", F.max("_v").over(_local(groups, order).rowsBetween(Window.unboundedPreceding, 0)))
    return (
        _with_carry(inside, carry, groups, ["_carry"], chunk is None)
        .withColumn(out, F.greatest("_carry", "_in"))
        .drop(CHUNK, "_v", "_in", "_carry")
    )


def previous(df: DataFrame, groups: list[str], order: list[str], values: dict[str, Column], chunk: Column | None = None) -> DataFrame:
    """Values of the row just before this one in its group; null on the first row."""
    columns = df.columns
    df = _chunked(df.withColumns({f"_v_{k}": c for k, c in values.items()}), groups, order, chunk)
    # one plain ordering column keeps this a hash aggregate; a struct would sort the rows first
    by = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    carry = (
        df.groupBy(*groups, CHUNK)
        .agg(*[F.max_by(f"_v_{k}", by).alias(f"_last_{k}") for k in values])
        .select(*groups, CHUNK, *[F.lag(f"_last_{k}").over(_chunks(groups)).alias(f"_carry_{k}") for k in values])
    )
    local = _local(groups, order)
    inside = df.withColumns({"_nth": F.row_number().over(local), **{f"_in_{k}": F.lag(f"_v_{k}").over(local) for k in values}})
    joined = _with_carry(inside, carry, groups, [f"_carry_{k}" for k in values], chunk is None)
    return joined.select(*columns, *[
        F.when(F.col("_nth") == 1, F.col(f"_carry_{k}")).otherwise(F.col(f"_in_{k}")).alias(k) for k in values])


def rolling_count(df: DataFrame, groups: list[str], seconds: str, span: float, out: str) -> DataFrame:
    """Rows of the same group in the closed range [t - span, t]; rows without a time are left out.

    Rows are counted per time first. A range's count is the running count up to its end less that before its
    begin, and both are points of one running sum, so no task holds a range.
    """
    reach = int(span * 1e6)
    rows = df.withColumn("_us", F.floor(F.col(seconds) * 1e6 + 0.5).cast("bigint")).where("_us is not null")
    times = rows.groupBy(*groups, "_us").agg(F.count(F.lit(1)).alias("_n"))
    # a begin stands before rows of the same time, which its range holds
    point = F.explode(F.array(
        F.struct((F.col("_us") - reach).alias("at"), F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("n")),
        F.struct(F.col("_us").alias("at"), F.lit(1).alias("kind"), F.col("_n").alias("n"))))
    points = times.select(*groups, point.alias("_p")).select(*groups, F.col("_p.at").alias("_at"), F.col("_p.kind").alias("_kind"), F.col("_p.n").alias("_n"))
    running = running_sum(points, groups, ["_at", "_kind"], F.col("_n"), "_upto")
    begin = F.col("_kind") == 0
    ranges = running.groupBy(*[F.col(g).alias(f"_of_{n}") for n, g in enumerate(groups)], F.when(begin, F.col("_at") + reach).otherwise(F.col("_at")).alias("_end")).agg(
        F.sum(F.when(begin, -F.col("_upto")).otherwise(F.col("_upto"))).alias(out))
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_of_{n}")) for n, g in enumerate(groups)], F.col("_us") == F.col("_end"))
    return rows.join(ranges, same).drop("_us", "_end", *[f"_of_{n}" for n in range(len(groups))])
