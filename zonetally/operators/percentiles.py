"""Exact percentiles with linear interpolation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

P50_95_99 = {"p50": 0.50, "p95": 0.95, "p99": 0.99}


def same_group(left: DataFrame, right: DataFrame, groups: list[str], how: str = "inner") -> DataFrame:
    """Join on the group columns, in which null equals null; the left side's columns stay."""
    other = right.select(*[F.col(g).alias(f"_of_{g}") if g in groups else F.col(g) for g in right.columns])
    on = reduce(lambda a, b: a & b, [left[g].eqNullSafe(other[f"_of_{g}"]) for g in groups])
    return left.join(other, on, how).drop(*[f"_of_{g}" for g in groups])


def _holding(counts: DataFrame, groups: list[str], part: str, ps: dict[str, float]) -> DataFrame:
    """The parts of each group in which a wanted rank lies: (groups, part, _start, _all, _low, _high).

    `counts` has `_n` equal values per row. Rows that were located before carry `_start`, the rows of the
    group before theirs, and `_all`, the rows of the group.
    """
    inside = [g for g in counts.columns if g in ("_start", "_all")]
    sums = counts.groupBy(*groups, *inside, part).agg(F.sum("_n").alias("_in_part"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    whole = Window.partitionBy(*groups)
    earlier = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_in_part").over(earlier), F.lit(0)) + (F.col("_start") if inside else F.lit(0))
    sums = sums.select(*groups, part, "_in_part", "_low", "_high", before.alias("_start"),
                       (F.col("_all") if inside else F.sum("_in_part").over(whole)).alias("_all"))
    wanted = F.lit(False)
    for p in ps.values():
        for rank in (F.floor(p * (F.col("_all") - 1)), F.ceil(p * (F.col("_all") - 1))):
            wanted = wanted | ((rank >= F.col("_start")) & (rank < F.col("_start") + F.col("_in_part")))
    return sums.where(wanted).drop("_in_part")


def exact_percentiles(df: DataFrame, groups: list[str], value: str, ps: dict[str, float] | None = None,
                      digits: int = 3, resolution: float = 1000.0, weight: str | None = None) -> DataFrame:
    """Exact percentiles of whole groups of any size, a null group included; null and NaN values are left out.

    Values are counted (`weight` says how often a row counts). Running totals of
    logarithmic buckets tell which buckets hold the wanted ranks, running totals
    of a thousand equal parts of those buckets which parts do, and only the
    distinct values of those parts are put in order. No task holds a group.
    """
    ps = P50_95_99 if ps is None else ps
    v = F.col(value).cast("double")
    bucket = F.signum("_v") * F.floor(F.log2(F.abs("_v") * resolution + 1.0) * 256)
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = (
        df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*groups, v.alias("_v")).agg(n.alias("_n")).withColumn("_bucket", bucket)
    )
    inside = same_group(counts, _holding(counts, groups, "_bucket", ps), [*groups, "_bucket"])
    width = F.col("_high") - F.col("_low")
    part = F.when(width > 0, F.floor((F.col("_v") - F.col("_low")) / width * 1000)).otherwise(F.lit(0))
    parts = inside.withColumn("_part", part).drop("_low", "_high")
    found = _holding(parts, [*groups, "_bucket"], "_part", ps).drop("_low", "_high")
    close = same_group(parts.drop("_start", "_all"), found, [*groups, "_bucket", "_part"])
    order = Window.partitionBy(*groups, "_bucket", "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = close.withColumn("_from", F.col("_start") + F.coalesce(F.sum("_n").over(order), F.lit(0)))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_from") + F.col("_n")), F.col("_v")))

    position = {name: F.lit(float(p)) * (F.col("_all") - 1) for name, p in ps.items()}
    picked = ranked.groupBy(*groups).agg(
        F.max("_all").alias("n"),
        *[at(F.floor(pos)).alias(f"_lo_{name}") for name, pos in position.items()],
        *[at(F.ceil(pos)).alias(f"_hi_{name}") for name, pos in position.items()],
    )
    values = []
    for name, p in ps.items():
        pos = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        values.append(F.round(lo + (hi - lo) * (pos - F.floor(pos)), digits).alias(name))
    return picked.select(*groups, "n", *values)
