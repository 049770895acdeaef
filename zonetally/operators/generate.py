"""Request tables with chosen popularity and arrival times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonetally.functions import columns as C
from zonetally.functions import domains as D
from zonetally.operators import prefix
from zonetally.session import store


def zipf_probabilities(items: DataFrame, rank: str, s: float = 1.2) -> DataFrame:
    """Adds `probability`, rank^-s over the sum of all."""
    weight = F.pow(F.col(rank).cast("double"), F.lit(-float(s)))
    weighted = items.withColumn("_w", weight)
    total = weighted.agg(F.sum("_w")).scalar()
    return weighted.withColumn("probability", F.col("_w") / total).drop("_w")


def rank_by(items: DataFrame, order: str, out: str = "rank") -> DataFrame:
    """Position of each item in the order of a unique column, counted range by range."""
    return prefix.running_sum(items, [], [order], F.lit(1), out)


def cumulative_intervals(items: DataFrame, order: str) -> DataFrame:
    """Gives each item the part [lo, hi) of the unit interval that its probability fills.

    Each part begins where the one before ends and the last ends at 1, so every
    number in [0, 1) lies in exactly one of them.
    """
    last = items.agg(F.max(order)).scalar()
    summed = prefix.running_sum(items, [], [order], F.col("probability"), "hi")
    closed = summed.withColumn("hi", F.when(F.col(order) == last, 1.0).otherwise(F.least("hi", F.lit(1.0))))
    bounded = prefix.previous(closed, [], [order], {"lo": F.col("hi")})
    return bounded.withColumn("lo", F.coalesce("lo", F.lit(0.0)))


#: Items up to which they travel to the draws; more are joined by shuffle. The rows are the same.
FEW_ITEMS = 100_000


def sample_items(draws: DataFrame, u: str, items: DataFrame) -> DataFrame:
    """Weighted sampling with replacement: the item whose interval holds each draw's number.

    Both sides meet on cells of the unit interval, of which there are at least as
    many as items. Draws are uniform over the cells whatever the weights, so even an item with a third of the
    weight is spread over a third of the cells. In a cell with many small items,
    draws and items meet on its parts once more, so no draw passes more than a few items.
    """
    items = store(draws.sparkSession, items, "items")
    n = items.count()
    cells = 1 << max(10, (n - 1).bit_length())
    full = store(draws.sparkSession, items.groupBy(F.floor(F.col("lo") * cells).alias("_cell")).agg(F.count(F.lit(1)).alias("_held"))
                 .select("_cell", F.pow(2, F.ceil(F.log2("_held"))).cast("bigint").alias("_parts")).where("_parts > 1"), "cells")
    first = F.floor(F.col("lo") * cells)
    last = F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1))
    spread = items.withColumn("_cell", F.explode(F.sequence(first, last))).join(full, "_cell", "left").na.fill(1, ["_parts"])
    scaled = F.lit(cells) * F.col("_parts")
    begin = F.greatest(F.floor(F.col("lo") * scaled), F.col("_cell") * F.col("_parts"))
    end = F.least(F.floor(F.col("hi") * scaled), (F.col("_cell") + 1) * F.col("_parts") - 1)
    spread = spread.withColumn("_part", F.explode(F.sequence(begin, end))).drop("_parts")
    placed = draws.withColumn("_cell", F.floor(F.col(u) * cells)).join(F.broadcast(full) if n <= FEW_ITEMS else full, "_cell", "left").na.fill(1, ["_parts"])
    placed = placed.withColumn("_part", F.floor(F.col(u) * scaled)).drop("_parts")
    spread = spread.select("_cell", "_part", *items.columns)
    return (
        placed.join(F.broadcast(spread) if n <= FEW_ITEMS else spread, ["_cell", "_part"])
        .where((F.col(u) >= F.col("lo")) & (F.col(u) < F.col("hi"))).drop("_cell", "_part", "lo", "hi")
    )


def unit_gap(u: Column) -> Column:
    """Exponential gap of mean 1 from a uniform number."""
    return -F.log(1.0 - u)


def arrival_times(rows: DataFrame, order: str, gap: Column, chunk: Column, rate: float,
                  spike_at: float | None = None, spike_rate: float | None = None) -> DataFrame:
    """Adds `arrival_sec`. The first row arrives at 0; each later one after its gap.

    The gaps are summed at unit rate. With a spike, the first arrival at or after
    `spike_at` is found on the base rate, and later gaps run at the spike rate.
    """
    summed = prefix.running_sum(rows.withColumn("_gap", gap), [], [order], F.col("_gap"), "_sum", chunk)
    at = F.col("_sum") - F.col("_gap")
    if spike_at is None or spike_rate is None:
        return summed.withColumn("arrival_sec", at / rate).drop("_gap", "_sum")
    timed = summed.withColumn("_at", at)
    turn = timed.where(F.col("_at") >= spike_at * rate).agg(F.min("_at")).scalar()
    arrival = F.when(F.col("_at") > turn, turn / rate + (F.col("_at") - turn) / spike_rate).otherwise(F.col("_at") / rate)
    return timed.withColumn("arrival_sec", arrival).drop("_gap", "_sum", "_at")


def other_zone_choices(s: float | None) -> dict[str, tuple[list[str], list[float]]]:
    """For each zone, the other zones with their weights: by position in the order of popularity, or equal without s."""
    weights = dict(zip(D.ZONE_POPULARITY, C.zipf_weights(len(D.ZONE_POPULARITY), s) if s is not None else [1.0] * len(D.ZONE_POPULARITY)))
    return {z: ([o for o in weights if o != z], [w for o, w in weights.items() if o != z]) for z in weights}


def build_requests(rows: DataFrame, row_id: str, distribution: str = "zipf", s: float = 1.2, seed: int = 42) -> DataFrame:
    """A request per row; popularity by position in the fixed orders. The second zone of a comparison is drawn from the
    zones that are left, with their weights."""
    if distribution not in ("zipf", "uniform"):
        raise ValueError(f"unknown distribution: {distribution}")
    power = s if distribution == "zipf" else None

    def number(salt: str) -> Column:
        return C.uniform01(F.lit(seed), F.lit(salt), F.col(row_id))

    def chosen(u: str, items: list) -> Column:
        weights = C.zipf_weights(len(items), s) if power is not None else [1.0] * len(items)
        return C.pick(F.col(u), items, weights)

    # the numbers are columns of their own, so that each is hashed once and not per comparison
    kind = F.col("query_type")
    drawn = (
        rows.withColumns({f"_u_{salt}": number(salt) for salt in ("type", "zone", "pair", "floor", "bins")})
        .withColumns({"query_type": chosen("_u_type", D.QUERY_POPULARITY), "zone_a": chosen("_u_zone", D.ZONE_POPULARITY)})
    )
    second = F.coalesce(*[
        F.when(F.col("zone_a") == z, C.pick(F.col("_u_pair"), *others)) for z, others in other_zone_choices(power).items()])
    return drawn.select(
        *rows.columns, "query_type", "zone_a",
        F.when(kind == "Q4", second).alias("zone_b"),
        F.when(kind != "Q5", chosen("_u_floor", D.CONFIDENCE_LEVELS)).alias("confidence_min"),
        F.when(kind == "Q5", chosen("_u_bins", D.BIN_LEVELS)).alias("bins"),
    )
