"""Lag of topics, peak backlog and recovery time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonetally.operators import prefix


def partition_lag(high: Column, committed: Column) -> Column:
    """Messages behind; without a commit the whole log counts."""
    return F.greatest(high - F.greatest(F.coalesce(committed, F.lit(0)), F.lit(0)), F.lit(0))


def topic_lag(polls: DataFrame) -> DataFrame:
    return polls.groupBy("poll_ts", "topic").agg(
        F.sum(partition_lag(F.col("high_offset"), F.col("committed_offset"))).alias("lag"))


def total_lag(polls: DataFrame, topics: list[str]) -> DataFrame:
    """Lag per topic and of all listed topics together (topic is null there)."""
    return (
        polls.where(F.col("topic").isin(topics))
        .withColumn("_lag", partition_lag(F.col("high_offset"), F.col("committed_offset")))
        .rollup("poll_ts", "topic").agg(F.sum("_lag").alias("lag"))
        .where(F.col("poll_ts").isNotNull())
    )


def in_flight(spans: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Number of open spans after each change: (key, t, total), one row per key and time."""
    changes = spans.select(key, F.inline(F.array(
        F.struct(F.col(start).alias("t"), F.lit(1).alias("step")),
        F.struct(F.col(end).alias("t"), F.lit(-1).alias("step")),
    ))).groupBy(key, "t").agg(F.sum("step").alias("step"))
    return prefix.running_sum(changes, [key], ["t"], F.col("step"), "total").drop("step")


def running_peak(backlog: DataFrame, key: str) -> DataFrame:
    """Adds `peak`, the largest total so far (at least 0)."""
    return prefix.running_max(backlog, [key], ["t"], F.greatest(F.col("total"), F.lit(0)), "peak")


def new_peaks(backlog: DataFrame, key: str) -> DataFrame:
    """Every time the peak grew, and to what. Peaks only grow, so a peak's first row set it."""
    return (
        running_peak(backlog, key).where(F.col("peak") > 0)
        .groupBy(key, "peak").agg(F.min("t").alias("peak_time"))
    )


def recovery(backlog: DataFrame, key: str) -> DataFrame:
    """Peak and recovery time per key.

    Each value of the running peak names one segment: the rows from that peak to
    the next higher one. A segment recovers at its first zero. The newest recovered
    segment gives the recovery time, the newest segment of all the draining flag.
    """
    first_zero = F.min(F.when(F.col("total") == 0, F.col("t")))
    segments = (
        running_peak(backlog, key)
        .groupBy(key, "peak").agg(F.min("t").alias("peak_time"), first_zero.alias("zero_time"),
                                  F.max("t").alias("end"), F.max_by("total", "t").alias("total"))
    )
    recovered = F.when((F.col("peak") > 0) & F.col("zero_time").isNotNull(), F.col("peak"))
    out = segments.groupBy(key).agg(
        F.max("peak").alias("_peak"), F.max_by("peak_time", "peak").alias("_time"), F.max_by("zero_time", "peak").alias("_zero"),
        F.max_by(F.col("zero_time") - F.col("peak_time"), recovered).alias("_recovery"), F.max_by("total", "end").alias("_now"))
    some = F.col("_peak") > 0
    return out.select(
        key, F.col("_now").alias("backlog_total"), F.col("_peak").alias("peak_backlog"),
        F.when(some, F.col("_time")).alias("peak_time"), F.round("_recovery", 2).alias("recovery_time_sec"),
        (some & F.col("_zero").isNull()).alias("draining"),
    )
