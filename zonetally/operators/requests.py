"""Answers for whole tables of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonetally.functions import columns as C
from zonetally.functions import domains as D
from zonetally.operators.zones import winner
from zonetally.session import small, store

def typed_params(df: DataFrame, schema, params: str = "params") -> DataFrame:
    """JSON parameters as columns, with their defaults."""
    p = F.from_json(params, schema)
    return df.withColumn("_p", p).select(
        *[c for c in df.columns if c not in (params, "retry_count")],
        F.col("_p.zone_id").alias("zone_id"), F.col("_p.zone_a").alias("zone_a"), F.col("_p.zone_b").alias("zone_b"),
        F.coalesce("_p.confidence_min", F.lit(0.0)).alias("confidence_min"),
        F.coalesce("_p.bins", F.lit(D.DEFAULT_BINS)).alias("bins"),
        F.coalesce("retry_count", F.lit(0)).alias("retry_count"),
    )


def enrich(requests: DataFrame, now: Column | None = None) -> DataFrame:
    """A message for each request: identity, no retries yet, creation time."""
    created = F.unix_micros(F.current_timestamp()) / F.lit(1e6) if now is None else now
    return requests.select(
        F.expr("uuid()").alias("uuid"), *requests.columns,
        F.lit(0).alias("retry_count"), created.alias("created_at"),
    )


def with_key(requests: DataFrame) -> DataFrame:
    return requests.withColumn("cache_key", C.request_key(
        F.col("query_type"), F.col("zone_a"), F.col("zone_b"), F.col("confidence_min"), F.col("bins")))


def with_reject_reason(requests: DataFrame, zones: DataFrame) -> DataFrame:
    """Adds `reject_reason`, null for a request that has an answer."""
    def known(side: str) -> DataFrame:
        return small(zones.select(F.col("zone_id").alias(f"zone_{side}"), F.lit(True).alias(f"_known_{side}")).distinct())

    reason = C.request_reject_reason(F.col("query_type"), F.col("zone_a"), F.col("zone_b"), F.col("_known_a"), F.col("_known_b"),
                                     F.col("confidence_min"), F.col("bins"))
    joined = requests.join(known("a"), "zone_a", "left").join(known("b"), "zone_b", "left")
    return joined.withColumn("reject_reason", reason).select(*requests.columns, "reject_reason")


CELLS = 1000  # parts of the confidence scale in which values are put in order, each in a task of its own


def totals_at(points: DataFrame, buildings: DataFrame) -> DataFrame:
    """(zone_id, x, n, area) at each of the distinct `points` (zone_id, x): buildings of the zone with a confidence of x or more.

    Buildings are first reduced to a row per zone and confidence. These rows and
    the points are put in order together, cell by cell, and summed from the top;
    totals of cells carry on. So the work grows with buildings plus points, and not with
    their product. A building without a usable confidence reaches no point.
    """
    x = F.col("confidence").cast("double")
    values = buildings.where(x.isNotNull() & ~F.isnan(x)).groupBy("zone_id", x.alias("x")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("area_in_meters").alias("area"), F.lit(False).alias("asked"))
    asked = points.select("zone_id", "x", F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("area"), F.lit(True).alias("asked"))
    cell = F.floor(F.greatest(F.lit(-1.0), F.least(F.col("x"), F.lit(2.0))) * CELLS)
    line = values.join(small(points.select("zone_id").distinct()), "zone_id", "left_semi").unionByName(asked).withColumn("cell", cell)
    higher = Window.partitionBy("zone_id").orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    cells = line.groupBy("zone_id", "cell").agg(F.sum("n").alias("n"), F.sum("area").alias("area")).select(
        "zone_id", "cell", F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("n_above"),
        F.coalesce(F.sum("area").over(higher), F.lit(0.0)).alias("area_above"))
    # of equal values, the point comes last and so counts them
    inside = Window.partitionBy("zone_id", "cell").orderBy(F.desc("x"), "asked").rowsBetween(Window.unboundedPreceding, 0)
    summed = line.withColumns({"n": F.sum("n").over(inside), "area": F.sum("area").over(inside)})
    return summed.where("asked").join(cells, ["zone_id", "cell"]).select(
        "zone_id", "x", (F.col("n") + F.col("n_above")).alias("n"),
        (F.coalesce("area", F.lit(0.0)) + F.col("area_above")).alias("area"))


def floor_totals(asked: DataFrame, buildings: DataFrame, zones: DataFrame) -> DataFrame:
    """(zone_id, floor, n, area, area_km2) of the distinct `asked` (zone_id, floor). A floor of 0 keeps all rows."""
    positive = asked.where("floor > 0").withColumnRenamed("floor", "x")
    some = totals_at(positive, buildings).withColumnRenamed("x", "floor")
    everything = buildings.groupBy("zone_id").agg(F.count(F.lit(1)).alias("n"), F.sum("area_in_meters").alias("area"))
    every = asked.where("floor <= 0").join(everything, "zone_id", "left").select(
        "zone_id", "floor", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("area", F.lit(0.0)).alias("area"))
    return some.unionByName(every).join(small(zones.select("zone_id", "area_km2")), "zone_id")


def histogram_rows(asked: DataFrame, buildings: DataFrame) -> DataFrame:
    """(zone_id, bins, bucket, min, max, count) of the distinct `asked` (zone_id, bins), a row per bucket.

    A bucket holds what reaches its lower edge less what reaches the next one; the last also holds 1 itself.
    """
    bucket, bins = F.col("bucket"), F.col("bins")
    # a last point just above 1 takes away what lies beyond the scale
    edge = F.when(bucket == bins, F.lit(1.0 + 2.0**-52)).otherwise(bucket * (F.lit(1.0) / bins))
    edges = asked.withColumn("bucket", F.explode(F.sequence(F.lit(0), bins))).withColumn("x", edge)
    reached = totals_at(edges.select("zone_id", "x").distinct(), buildings).select("zone_id", "x", F.col("n").alias("reach"))
    known = edges.join(reached, ["zone_id", "x"])
    after = known.select("zone_id", "bins", (bucket - 1).alias("bucket"), F.col("reach").alias("next"))
    return known.join(after, ["zone_id", "bins", "bucket"]).select(
        "zone_id", "bins", "bucket", (bucket / bins).alias("min"), ((bucket + 1) / bins).alias("max"),
        (F.col("reach") - F.col("next")).alias("count"))


def answer_requests(requests: DataFrame, buildings: DataFrame, zones: DataFrame) -> DataFrame:
    """All valid requests with their answers; together with `with_reject_reason` every request has one or the other.

    The distinct floors and histograms that are asked for are answered from the
    buildings, each once, and stored; then every request looks its own up. Any
    floor and any number of bins takes the same way.
    """
    spark = requests.sparkSession
    judged = with_reject_reason(requests, zones).where(F.col("reject_reason").isNull()).drop("reject_reason")
    kind = F.upper("query_type")
    floor = F.greatest(F.coalesce(F.col("confidence_min").cast("double"), F.lit(0.0)), F.lit(0.0))
    bins = F.coalesce(F.col("bins").cast("int"), F.lit(D.DEFAULT_BINS))
    valid = with_key(judged).withColumns({"floor": F.when(kind != "Q5", floor), "bins": F.when(kind == "Q5", bins)})
    valid = store(spark, valid.select("request_id", "cache_key", "query_type", "zone_a", "zone_b", "floor", "bins"), "requests")

    sides = F.explode(F.array(F.col("zone_a"), F.when(kind == "Q4", F.col("zone_b"))))
    floors = valid.where("floor is not null").select(sides.alias("zone_id"), "floor").where("zone_id is not null").distinct()
    totals = store(spark, floor_totals(floors, buildings, zones), "floors")
    asked = valid.where("bins is not null").select(F.col("zone_a").alias("zone_id"), "bins").distinct()
    bucket = F.struct("bucket", "min", "max", "count")
    arrays = store(spark, histogram_rows(asked, buildings).groupBy("zone_id", "bins").agg(F.array_sort(F.collect_list(bucket)).alias("buckets")), "buckets")

    def of(side: str) -> DataFrame:
        return totals.select(F.col("zone_id").alias(f"zone_{side}"), "floor", *[F.col(c).alias(f"{c}_{side}") for c in ("n", "area", "area_km2")])

    found = valid.join(of("a"), ["zone_a", "floor"], "left").join(of("b"), ["zone_b", "floor"], "left").join(
        arrays.withColumnRenamed("zone_id", "zone_a"), ["zone_a", "bins"], "left")

    def dens(side: str) -> Column:
        n, area = F.col(f"n_{side}"), F.col(f"area_km2_{side}")
        return F.when(area > 0, n / area).otherwise(0.0)

    a, b = dens("a"), dens("b")
    return found.select(
        "request_id", "cache_key", "query_type",
        F.when(kind.isin("Q1", "Q2", "Q3"), F.col("n_a")).alias("n"),
        F.when(kind == "Q2", F.when(F.col("n_a") > 0, F.col("area_a") / F.col("n_a")).otherwise(0.0)).alias("avg_area"),
        F.when(kind == "Q2", F.col("area_a")).alias("total_area"),
        F.when(kind.isin("Q3", "Q4"), a).alias("density_a"),
        F.when(kind == "Q4", b).alias("density_b"),
        F.when(kind == "Q4", winner(F.col("zone_a"), F.col("zone_b"), a, b)).alias("winner"),
        "buckets",
    )


def look_up(requests: DataFrame, results: DataFrame) -> DataFrame:
    """HIT with the stored result, or MISS. `results` holds one row per key."""
    stored = results.withColumn("_stored", F.lit(True))
    joined = requests.join(stored, "cache_key", "left")
    return joined.withColumn("cache", F.when(F.col("_stored"), "HIT").otherwise("MISS")).drop("_stored")


def to_compute(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Distinct keys without a stored result."""
    return requests.select("cache_key").distinct().join(results.select("cache_key"), "cache_key", "left_anti")


def already_stored(requests: DataFrame, results: DataFrame) -> DataFrame:
    return requests.join(results.select("cache_key"), "cache_key", "left_semi")


def distinct_keys(requests: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of distinct keys; the approximate form keeps one small sketch per task."""
    n = F.approx_count_distinct("cache_key", 0.01) if approximate else F.count_distinct("cache_key")
    return requests.agg(n.cast("bigint").alias("n_keys"))
