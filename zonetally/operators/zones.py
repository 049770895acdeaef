"""Counts, areas, densities, comparisons and histograms by zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonetally.functions import columns as C
from zonetally.functions import domains as D
from zonetally.session import small, store


def zone_dimension(spark: SparkSession, more: list[tuple] | None = None) -> DataFrame:
    """The five zones, and `more` like them, with their area."""
    rows = ", ".join(
        f"('{zid}', '{name}', {a}D, {b}D, {c}D, {d}D)" for zid, name, a, b, c, d in [*D.ZONES, *(more or [])]
    )
    zones = spark.sql(
        f"select * from values {rows} as z(zone_id, zone_name, lat_min, lat_max, lon_min, lon_max)"
    )
    return zones.withColumn("area_km2", C.zone_area_km2(*[F.col(c) for c in zones.columns[2:]]))


def in_known_zones(buildings: DataFrame, zones: DataFrame) -> DataFrame:
    return buildings.join(small(zones.select("zone_id")), "zone_id", "left_semi")


def in_unknown_zones(buildings: DataFrame, zones: DataFrame) -> DataFrame:
    return buildings.join(small(zones.select("zone_id")), "zone_id", "left_anti")


def one_zone(buildings: DataFrame, zones: DataFrame, zone_id: str) -> DataFrame:
    """Rows of a zone; asking for a zone that does not exist is an error."""
    if zones.where(F.col("zone_id") == zone_id).isEmpty():
        raise ValueError(f"unknown zone: {zone_id}")
    return buildings.where(F.col("zone_id") == zone_id)


def keep_confident(buildings: DataFrame, confidence_min: float) -> DataFrame:
    """Confidence floor; a floor of 0 or less adds no filter at all."""
    if confidence_min <= 0:
        return buildings
    return buildings.where((F.col("confidence") >= float(confidence_min)) & ~F.isnan("confidence"))


def _per_zone(buildings: DataFrame, zones: DataFrame, confidence_min: float, aggs: list[Column]) -> DataFrame:
    """Aggregates of every zone, also of zones without rows."""
    totals = keep_confident(buildings, confidence_min).groupBy("zone_id").agg(*aggs)
    return zones.join(totals, "zone_id", "left")


def building_count(buildings: DataFrame, zones: DataFrame, confidence_min: float = 0.0) -> DataFrame:
    out = _per_zone(buildings, zones, confidence_min, [F.count(F.lit(1)).alias("n")])
    return out.select("zone_id", F.lit(float(confidence_min)).alias("confidence_min"),
                      F.coalesce("n", F.lit(0)).alias("count"))


def area_totals(buildings: DataFrame, zones: DataFrame, confidence_min: float = 0.0) -> DataFrame:
    aggs = [
        F.avg("area_in_meters").alias("avg_area"),
        F.sum("area_in_meters").alias("total_area"),
        F.count(F.lit(1)).alias("n"),
    ]
    out = _per_zone(buildings, zones, confidence_min, aggs)
    return out.select(
        "zone_id", F.lit(float(confidence_min)).alias("confidence_min"),
        F.coalesce("avg_area", F.lit(0.0)).alias("avg_area"),
        F.coalesce("total_area", F.lit(0.0)).alias("total_area"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def density(buildings: DataFrame, zones: DataFrame, confidence_min: float = 0.0) -> DataFrame:
    out = _per_zone(buildings, zones, confidence_min, [F.count(F.lit(1)).alias("n")])
    n = F.coalesce("n", F.lit(0))
    return out.select(
        "zone_id", F.lit(float(confidence_min)).alias("confidence_min"), n.alias("count"), "area_km2",
        F.when(F.col("area_km2") > 0, n / F.col("area_km2")).otherwise(0.0).alias("density_per_km2"),
    )


def _with_all(rows: DataFrame, zones: DataFrame, out: str) -> DataFrame:
    """Each row once per zone. Ordered pairs of zones are what is asked for; their number is that of the dimension."""
    ids = zones.agg(F.collect_set("zone_id")).scalar()
    return rows.withColumn("_zones", ids).withColumn(out, F.explode("_zones")).drop("_zones")


def compare_zones(densities: DataFrame) -> DataFrame:
    """Denser zone of every ordered pair; a tie goes to the second zone. Densities are stored, one row per zone, so
    that pairs, zones and their number are read from them and buildings are summed up once."""
    densities = store(densities.sparkSession, densities, "densities")
    b = densities.select(F.col("zone_id").alias("zone_b"), F.col("density_per_km2").alias("density_b"))
    pairs = _with_all(densities, densities, "zone_b").select(
        F.col("zone_id").alias("zone_a"), "confidence_min", F.col("density_per_km2").alias("density_a"), "zone_b")
    return (
        pairs.where(F.col("zone_a") != F.col("zone_b")).join(small(b), "zone_b")
        .select("zone_a", "zone_b", "confidence_min", "density_a", "density_b",
                winner(F.col("zone_a"), F.col("zone_b"), F.col("density_a"), F.col("density_b")).alias("winner"))
    )


def winner(zone_a: Column, zone_b: Column, density_a: Column, density_b: Column) -> Column:
    return F.when(density_a > density_b, zone_a).otherwise(zone_b)


def confidence_histogram(buildings: DataFrame, zones: DataFrame, bins: int = D.DEFAULT_BINS) -> DataFrame:
    """One row per zone and bucket, empty buckets included."""
    if bins < 1:
        raise ValueError("bins must be positive")
    n = F.lit(int(bins))
    counts = (
        buildings.select("zone_id", C.bin_index(F.col("confidence"), n).alias("bucket"))
        .where(F.col("bucket").isNotNull())
        .groupBy("zone_id", "bucket").agg(F.count(F.lit(1)).alias("n"))
    )
    grid = zones.select("zone_id", F.explode(F.sequence(F.lit(0), n - 1)).alias("bucket"))
    return grid.join(counts, ["zone_id", "bucket"], "left").select(
        "zone_id", n.alias("bins"), "bucket",
        (F.col("bucket") / n).alias("min"),
        ((F.col("bucket") + 1) / n).alias("max"),
        F.coalesce("n", F.lit(0)).alias("count"),
    )


def histogram_arrays(histogram: DataFrame) -> DataFrame:
    """The buckets of a zone as one ordered array."""
    bucket = F.struct("bucket", "min", "max", "count")
    return histogram.groupBy("zone_id", "bins").agg(F.array_sort(F.collect_list(bucket)).alias("buckets"))


def building_totals(buildings: DataFrame, zones: DataFrame) -> DataFrame:
    """Buildings per zone with name and area, and the total over all zones."""
    counts = (
        buildings.groupBy("zone_id").agg(F.count(F.lit(1)).alias("n")).join(small(zones.select("zone_id")), "zone_id", "left_semi")
        .rollup("zone_id").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("buildings"))
    )
    return counts.join(small(zones), "zone_id", "left").select(
        F.coalesce("zone_id", F.lit("all")).alias("zone_id"), "zone_name", "area_km2", "buildings")


def other_zones(zones: DataFrame) -> DataFrame:
    """For each zone, all zones but itself."""
    pairs = _with_all(zones.select("zone_id"), zones, "other")
    return pairs.exceptAll(zones.select("zone_id", F.col("zone_id").alias("other")))


def zone_stats(buildings: DataFrame, zones: DataFrame) -> DataFrame:
    """Every zone with name, area and number of buildings, 0 where it has none."""
    out = _per_zone(buildings, zones, 0.0, [F.count(F.lit(1)).alias("n")])
    return out.select("zone_id", "zone_name", "area_km2", F.coalesce("n", F.lit(0)).alias("buildings"))
