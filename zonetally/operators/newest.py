"""The newest N rows of each group.

Rows compete in rounds. Each task first keeps the newest N of every group among its own rows (Spark's
group limit in front of a ranked window). Winners of tasks meet in one of a fixed number of heats per
group, and the heats' winners in a final. So no task ranks more than N rows of a group per task or heat that
sends them, also if all of a group's rows have one time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Heats of a group.
HEATS = 256


def _round(df: DataFrame, groups: list[str], seconds: str, tie: str, n: int) -> DataFrame:
    w = Window.partitionBy(*groups).orderBy(F.desc(seconds), F.desc(tie))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def _ranked(df: DataFrame, groups: list[str], seconds: str, tie: str, n: int) -> DataFrame:
    heats = _round(df.withColumn("_heat", F.spark_partition_id() % HEATS), [*groups, "_heat"], seconds, tie, n)
    return _round(heats.drop("_heat"), groups, seconds, tie, n)


def newest_of_few(df: DataFrame, group: str, members: list, seconds: str, tie: str, n: int, slot_seconds: float = 60.0) -> DataFrame:
    """Newest N rows of each group in a fixed list; other groups are not asked for.

    Rows are counted per group and time slot first, which needs no row shuffle.
    The counts give each group a slot from which on its newest N rows lie, and
    only rows from that slot on are shuffled and ranked. The cut-off table has one
    row per listed group, which bounds the broadcast.
    """
    df = df.where(F.col(group).isin(members)).withColumn("_slot", F.floor(F.col(seconds) / F.lit(float(slot_seconds))))
    newer = Window.partitionBy(group).orderBy(F.desc("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        df.groupBy(group, "_slot").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_newer", F.coalesce(F.sum("_n").over(newer), F.lit(0)))
        .where(F.col("_newer") < n)
        .groupBy(group).agg(F.min("_slot").alias("_cut"))
    )
    candidates = df.join(F.broadcast(cut), group).where(F.col("_slot") >= F.col("_cut")).drop("_slot", "_cut")
    return _ranked(candidates, [group], seconds, tie, n)


def newest_of_many(df: DataFrame, groups: list[str], seconds: str, tie: str, n: int) -> DataFrame:
    """Newest N rows for any number of groups."""
    return _ranked(df, groups, seconds, tie, n)


def newest_overall(df: DataFrame, seconds: str, tie: str, n: int) -> DataFrame:
    """The newest N rows of all: each task sends its own N."""
    return df.orderBy(F.desc(seconds), F.desc(tie)).limit(n)
