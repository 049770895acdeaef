"""Zone analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonetally import schemas
from zonetally.functions import columns as C
from zonetally.functions import domains as D
from zonetally.operators import zones as Z
from zonetally.plans.fixtures import buildings
from zonetally.plans.registry import query, rounded
from zonetally.session import scratch_path
from zonetally.sources.readers import read_buildings

FLOOR = 0.36
B, ZB = ("buildings",), ("zones", "buildings")


@query("src01_buildings_scan", """
select zone_id, count(*) as n, round(sum(area_in_meters), 4) as total_area, max(confidence) as top_confidence
from buildings group by zone_id""", B)
def _(spark, d):
    path = scratch_path(spark, "buildings")
    buildings(spark, d).write.parquet(path)
    out = read_buildings(spark, path).groupBy("zone_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("area_in_meters").alias("total_area"),
        F.max("confidence").alias("top_confidence"))
    return rounded(out, 4, "total_area")


@query("flt01_confidence_floor", """
select zone_id, 0.36::double as confidence_min, count(*) as n from buildings where confidence >= 0.36::double group by zone_id
union all select zone_id, 0.0::double, count(*) from buildings group by zone_id""", B)
def _(spark, d):
    def at(m):
        return Z.keep_confident(buildings(spark, d), m).groupBy("zone_id").agg(F.count(F.lit(1)).alias("n")).select(
            "zone_id", F.lit(m).alias("confidence_min"), "n")

    return at(FLOOR).unionByName(at(0.0))


@query("flt02_one_zone", """
select zone_id, count(*) as n, round(avg(area_in_meters), 4) as avg_area from buildings where zone_id = 'Z2' group by zone_id""", B)
def _(spark, d):
    out = Z.one_zone(buildings(spark, d), Z.zone_dimension(spark), "Z2").groupBy("zone_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg("area_in_meters").alias("avg_area"))
    return rounded(out, 4, "avg_area")


@query("prj14_zone_area", """
select z.zone_id, zone_name, round(area_km2, 6) as area_km2, round(sum(area_in_meters) / 1e6 / area_km2, 6) as built_share
from zones z join buildings b on b.zone_id = z.zone_id group by z.zone_id, zone_name, area_km2""", ZB)
def _(spark, d):
    built = buildings(spark, d).groupBy("zone_id").agg(F.sum("area_in_meters").alias("built"))
    out = built.join(F.broadcast(Z.zone_dimension(spark)), "zone_id").select(
        "zone_id", "zone_name", "area_km2", (F.col("built") / 1e6 / F.col("area_km2")).alias("built_share"))
    return rounded(out, 6, "area_km2", "built_share")


@query("jn01_zone_stats", """
select z.zone_id, zone_name, round(area_km2, 6) as area_km2, count(b.zone_id) as buildings
from zones z left join buildings b on b.zone_id = z.zone_id group by z.zone_id, zone_name, area_km2""", ZB)
def _(spark, d):
    return rounded(Z.zone_stats(buildings(spark, d), Z.zone_dimension(spark)), 6, "area_km2")


@query("jn02_known_and_unknown_zones", """
select case when zone_id in (select zone_id from zones) then 'known' else 'unknown' end as side, zone_id, count(*) as n
from buildings group by 1, 2""", ZB)
def _(spark, d):
    b, z = buildings(spark, d), Z.zone_dimension(spark)

    def count(df, side):
        return df.groupBy("zone_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(side).alias("side"), "zone_id", "n")

    return count(Z.in_known_zones(b, z), "known").unionByName(count(Z.in_unknown_zones(b, z), "unknown"))


PAIRS = """
with dens as (select z.zone_id, count(b.zone_id) / area_km2 as density from zones z
  left join buildings b on b.zone_id = z.zone_id and confidence >= 0.36::double group by z.zone_id, area_km2)
select a.zone_id as zone_a, b.zone_id as zone_b, 0.36::double as confidence_min, round(a.density, 6) as density_a,
  round(b.density, 6) as density_b, case when a.density > b.density then a.zone_id else b.zone_id end as winner
from dens a join dens b on a.zone_id <> b.zone_id"""


def _pairs(spark, d):
    dens = Z.density(buildings(spark, d), Z.zone_dimension(spark), FLOOR)
    return rounded(Z.compare_zones(dens), 6, "density_a", "density_b")


query("jn03_zone_pairs", PAIRS, ZB)(_pairs)
query("agg04_zone_comparison", f"select zone_a, zone_b, winner from ({PAIRS})", ZB)(
    lambda spark, d: _pairs(spark, d).select("zone_a", "zone_b", "winner"))


@query("srt03_winner_per_zone", f"""
select zone_a as zone_id, count(*) filter (where winner = zone_a) as wins, arg_max(zone_b, density_b) as densest_rival
from ({PAIRS}) group by 1""", ZB)
def _(spark, d):
    return _pairs(spark, d).groupBy(F.col("zone_a").alias("zone_id")).agg(
        F.count_if(F.col("winner") == F.col("zone_a")).alias("wins"),
        F.max_by("zone_b", "density_b").alias("densest_rival"))


@query("agg01_zone_count", """
select z.zone_id, 0.36::double as confidence_min, count(b.zone_id) as count
from zones z left join buildings b on b.zone_id = z.zone_id and confidence >= 0.36::double group by z.zone_id""", ZB)
def _(spark, d):
    return Z.building_count(buildings(spark, d), Z.zone_dimension(spark), FLOOR)


@query("agg02_zone_area", """
select z.zone_id, 0.36::double as confidence_min, round(coalesce(avg(area_in_meters), 0), 4) as avg_area,
  round(coalesce(sum(area_in_meters), 0), 4) as total_area, count(b.zone_id) as n
from zones z left join buildings b on b.zone_id = z.zone_id and confidence >= 0.36::double group by z.zone_id""", ZB)
def _(spark, d):
    out = Z.area_totals(buildings(spark, d), Z.zone_dimension(spark), FLOOR)
    return rounded(out, 4, "avg_area", "total_area")


@query("agg03_zone_density", """
select z.zone_id, 0.36::double as confidence_min, count(b.zone_id) as count, round(area_km2, 6) as area_km2,
  round(count(b.zone_id) / area_km2, 6) as density_per_km2
from zones z left join buildings b on b.zone_id = z.zone_id and confidence >= 0.36::double group by z.zone_id, area_km2""", ZB)
def _(spark, d):
    return rounded(Z.density(buildings(spark, d), Z.zone_dimension(spark), FLOOR), 6, "area_km2", "density_per_km2")


def _index_sql(x: str, n: str) -> str:
    """Bin by its edges: the last bin whose lower edge x reaches."""
    return f"list_max(list_filter(range(0, {n}), lambda i: {x} >= i * (1.0::double / {n})))"


HISTOGRAM = f"""
with idx as (select zone_id, {_index_sql('confidence', '10')} as bucket from buildings where confidence between 0 and 1)
select z.zone_id, 10 as bins, g.bucket::int as bucket, round(g.bucket / 10, 6) as min, round((g.bucket + 1) / 10, 6) as max,
  count(i.zone_id) as count
from zones z join (select unnest(range(0, 10)) as bucket) g on true
left join idx i on i.zone_id = z.zone_id and i.bucket = g.bucket group by 1, 2, 3, 4, 5"""


@query("agg05_confidence_histogram", HISTOGRAM, ZB)
def _(spark, d):
    return rounded(Z.confidence_histogram(buildings(spark, d), Z.zone_dimension(spark), 10), 6, "min", "max")


@query("agg05_histogram_arrays", f"""
select zone_id, bins, string_agg(count::varchar, ',' order by bucket) as counts from ({HISTOGRAM}) group by 1, 2""", ZB)
def _(spark, d):
    arrays = Z.histogram_arrays(Z.confidence_histogram(buildings(spark, d), Z.zone_dimension(spark), 10))
    return arrays.select("zone_id", "bins", F.array_join(F.col("buckets.count").cast("array<string>"), ",").alias("counts"))


@query("agg06_building_totals", """
select case when grouping(b.zone_id) = 1 then 'all' else b.zone_id end as zone_id, any_value(zone_name) filter (where true) as zone_name,
  count(*) as buildings from buildings b join zones z on z.zone_id = b.zone_id group by rollup (b.zone_id)
having grouping(b.zone_id) = 0 union all select 'all', null, count(*) from buildings where zone_id in (select zone_id from zones)""", ZB)
def _(spark, d):
    return Z.building_totals(buildings(spark, d), Z.zone_dimension(spark)).drop("area_km2")


@query("set03_other_zones", """
select z.zone_id, o.zone_id as other, count(b.zone_id) as buildings_there
from zones z join zones o on o.zone_id <> z.zone_id left join buildings b on b.zone_id = o.zone_id group by 1, 2""", ZB)
def _(spark, d):
    z = Z.zone_dimension(spark)
    counts = Z.zone_stats(buildings(spark, d), z).select(F.col("zone_id").alias("other"), F.col("buildings").alias("buildings_there"))
    return Z.other_zones(z).join(F.broadcast(counts), "other").select("zone_id", "other", "buildings_there")


SIXTH = ("Z6", "Sixth", -33.48, -33.45, -70.70, -70.66)
SIX = """zs as (select zone_id, area_km2 from zones union all
  select 'Z6', abs((-33.45::double + 33.48) * 111.32 * (-70.66::double + 70.70) * 111.32 * cos(radians((-33.48::double - 33.45) / 2))))"""


@query("agg03_density_with_a_sixth_zone", f"""
with {SIX} select z.zone_id, count(b.zone_id) as count, round(any_value(area_km2), 6) as area_km2, round(count(b.zone_id) / any_value(area_km2), 6) as density_per_km2
from zs z left join buildings b on b.zone_id = z.zone_id and confidence >= 0.36::double group by z.zone_id""", ZB)
def _(spark, d):
    """Zones come from the given table, also one that no fixed list knows."""
    out = Z.density(buildings(spark, d), Z.zone_dimension(spark, [SIXTH]), FLOOR)
    return rounded(out, 6, "area_km2", "density_per_km2").drop("confidence_min")
