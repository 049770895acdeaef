"""Input views derived from the test tables, for Spark and as SQL text.

SQL holds the views for another engine; the functions build the same rows here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonetally.functions import columns as C
from zonetally.functions import domains as D
from zonetally.operators import prefix


# Declared, so that opening a table needs no job that looks into its files.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": "l_suppkey bigint, l_quantity double, l_extendedprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _zone_of(n) -> Column:
    return F.concat(F.lit("Z"), n.cast("string"))


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buildings of six zones, Z6 not being a known one."""
    return table(spark, sf_dir, "lineitem").select(
        _zone_of(F.col("l_suppkey") % 6 + 1).alias("zone_id"),
        (F.col("l_quantity") / 50.0).alias("confidence"),
        (F.col("l_extendedprice") / 100.0).alias("area_in_meters"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def run_label() -> Column:
    user = F.col("user_id")

    def pick(n, items):
        return F.element_at(F.array(*[F.lit(i) for i in items]), (n % len(items) + 1).cast("int"))

    return F.concat_ws("_", pick(user, D.POLICIES), pick(F.floor(user / 3), D.SIZES), pick(F.floor(user / 9), D.DISTRIBUTIONS))


def scenario() -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in D.SCENARIOS]), (F.col("user_id") % 5 + 1).cast("int"))


def query_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry events; `all_runs`, `run` and `scenario` are three ways to group them."""
    k, kind = F.col("k"), F.col("event_type")
    return _events(spark, sf_dir).select(
        "event_id", C.epoch_seconds("ts").alias("ts"),
        F.when(kind == "click", "hit").when(kind == "view", "miss").when(kind == "purchase", "processed")
        .when(kind == "signup", "retry").when(kind == "error", F.when(k % 2 == 0, "dlq").otherwise("error"))
        .alias("event"),
        F.element_at(F.array(*[F.lit(f"q{i}") for i in range(1, 6)], F.lit(None)), k % 6 + 1).alias("query_type"),
        F.when(kind.isin("click", "view") & (k % 11 != 0), F.col("value")).alias("latency_ms"),
        F.when((kind == "purchase") & (k % 13 != 0), F.col("value")).alias("end_to_end_ms"),
        (k % 10 == 0).alias("from_retry"), (k % 4).alias("retry_count"),
        F.when(k % 3 != 0, "HIT").otherwise("MISS").alias("cache"),
        (F.col("user_id") % 6).alias("worker"), "user_id",
        F.lit("all").alias("all_runs"), run_label().alias("run"), scenario().alias("scenario"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of five known types and an unknown one; the zones of a pair differ."""
    k, user = F.col("k"), F.col("user_id")
    return _events(spark, sf_dir).select(
        F.col("event_id").alias("request_id"), C.epoch_seconds("ts").alias("created_at"),
        F.concat(F.lit("Q"), (k % 6 + 1).cast("string")).alias("query_type"),
        _zone_of(user % 5 + 1).alias("zone_a"), _zone_of((user + 1 + k % 4) % 5 + 1).alias("zone_b"),
        (((k % 21) * 5).cast("double") / 100.0).alias("confidence_min"),
        (k % 8 + 3).alias("bins"), (k % 4).alias("retry_count"),
    )


def offset_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily polls of six partitions. A poll counts what lies before it, so events are
    counted per first poll that sees them and summed along the polls."""
    day = 86400
    e = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 6).alias("part"),
        F.when(F.col("user_id") % 2 == 0, "main").otherwise("retry").alias("topic"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "value")
    done = F.col("us") + F.round(F.col("value") * 600).cast("bigint") * 1000000

    def first_poll(us):
        return F.ceil(us / F.lit(day * 1000000)) * day

    changes = e.select("topic", "part", F.inline(F.array(
        F.struct(first_poll(F.col("us")).alias("poll"), F.lit(1).alias("hi"), F.lit(0).alias("co")),
        F.struct(first_poll(done).alias("poll"), F.lit(0).alias("hi"), F.lit(1).alias("co")),
        # a poll happens on every day with events, also where a partition got none
        F.struct((F.floor(F.col("us") / F.lit(day * 1000000)) * day).alias("poll"), F.lit(0).alias("hi"), F.lit(0).alias("co")),
    )))
    per_poll = changes.groupBy("topic", "part", "poll").agg(F.sum("hi").alias("hi"), F.sum("co").alias("co"))
    days = e.select((F.floor(F.col("us") / F.lit(day * 1000000)) * day).alias("poll")).distinct()
    parts = e.select("topic", "part").distinct()
    grid = days.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(5)))).withColumn("part", F.col("part").cast("bigint"))
    filled = (
        grid.join(parts, "part").withColumn("asked", F.lit(True))
        .join(per_poll, ["topic", "part", "poll"], "full")
    )
    w = Window.partitionBy("topic", "part").orderBy("poll")
    return (
        filled.withColumn("high_offset", F.sum(F.coalesce("hi", F.lit(0))).over(w))
        .withColumn("committed_offset", F.nullif(F.sum(F.coalesce("co", F.lit(0))).over(w), F.lit(0)))
        .where("asked")
        .select(F.timestamp_seconds("poll").alias("poll_ts"), F.col("poll").cast("double").alias("poll_sec"),
                "topic", "part", "high_offset", "committed_offset")
    )


def spans(spark: SparkSession, sf_dir: str, seconds_per_value: int = 600) -> DataFrame:
    """A start and an end (epoch seconds) per event, as work in flight."""
    start = C.epoch_seconds("ts")
    return table(spark, sf_dir, "events").select(
        "user_id", scenario().alias("scenario"), start.alias("start_sec"),
        (start + F.round(F.col("value") * seconds_per_value)).alias("end_sec"))


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts of messages; a message is a user on a day."""
    e = table(spark, sf_dir, "events").select(
        F.concat(F.lit("m"), F.col("user_id").cast("string"), F.lit("-"), F.col("ts").cast("date").cast("string")).alias("uuid"),
        C.epoch_seconds("ts").alias("ts"), "event_id", (F.col("user_id") % 6).alias("worker"),
        (~F.col("event_type").isin("error", "signup")).alias("ok"))
    numbered = prefix.running_sum(e, ["uuid"], ["ts", "event_id"], F.lit(1), "attempt", prefix.time_chunk("ts"))
    return numbered.withColumn("retry_count", F.col("attempt") - 1)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .select(F.split(run_label(), "_").alias("l"), "event_type", "ts")
        .groupBy(F.col("l")[0].alias("policy"), F.col("l")[1].alias("size"), F.col("l")[2].alias("dist"))
        .agg(F.count_if(F.col("event_type") == "click").alias("hits"),
             F.count_if(F.col("event_type") == "view").alias("misses"), F.max("ts").alias("snapshot_ts"))
    )


_K = "(select *, cast(json_extract_string(props, '$.k') as int) as k from events)"
_RUN = (
    "concat(case user_id % 3 when 0 then 'LRU' when 1 then 'LFU' else 'FIFO' end, '_',"
    " case cast(floor(user_id / 3) as bigint) % 3 when 0 then '50mb' when 1 then '200mb' else '500mb' end, '_',"
    " case cast(floor(user_id / 9) as bigint) % 2 when 0 then 'zipf' else 'uniform' end)"
)
_SCENARIO = (
    "case user_id % 5 when 0 then 'base_sync' when 1 then 'kafka_1c' when 2 then 'kafka_3c'"
    " when 3 then 'failure' else 'spike' end"
)
_ZONE_VALUES = ", ".join(
    f"('{z}', '{name}', abs((({b}) - ({a})) * 111.32e0 * ((({d}) - ({c})) * 111.32e0 * cos(radians((({a}) + ({b})) / 2e0)))))"
    for z, name, a, b, c, d in [(z, n, f"{a!r}::double", f"{b!r}::double", f"{c!r}::double", f"{d!r}::double") for z, n, a, b, c, d in D.ZONES]
)

SQL = {
    "zones": f"select * from (values {_ZONE_VALUES}) v(zone_id, zone_name, area_km2)",
    "buildings": (
        "select concat('Z', cast(l_suppkey % 6 + 1 as varchar)) as zone_id,"
        " l_quantity / cast(50 as double) as confidence, l_extendedprice / cast(100 as double) as area_in_meters"
        " from lineitem"
    ),
    "query_events": f"""
select event_id, epoch_us(ts) / 1e6 as ts,
  case event_type when 'click' then 'hit' when 'view' then 'miss' when 'purchase' then 'processed'
       when 'signup' then 'retry' when 'error' then case when k % 2 = 0 then 'dlq' else 'error' end end as event,
  case when k % 6 < 5 then concat('q', cast(k % 6 + 1 as varchar)) end as query_type,
  case when event_type in ('click', 'view') and k % 11 <> 0 then value end as latency_ms,
  case when event_type = 'purchase' and k % 13 <> 0 then value end as end_to_end_ms,
  k % 10 = 0 as from_retry, k % 4 as retry_count,
  case when k % 3 <> 0 then 'HIT' else 'MISS' end as cache, user_id % 6 as worker, user_id,
  'all' as all_runs, {_RUN} as run, {_SCENARIO} as scenario
from {_K} e""",
    "requests": f"""
select event_id as request_id, epoch_us(ts) / 1e6 as created_at,
  concat('Q', cast(k % 6 + 1 as varchar)) as query_type,
  concat('Z', cast(user_id % 5 + 1 as varchar)) as zone_a,
  concat('Z', cast((user_id + 1 + k % 4) % 5 + 1 as varchar)) as zone_b,
  cast((k % 21) * 5 as double) / 100 as confidence_min, 3 + k % 8 as bins, k % 4 as retry_count
from {_K} e""",
    "offset_polls": """
select poll_ts, epoch(poll_ts)::double as poll_sec, case user_id % 2 when 0 then 'main' else 'retry' end as topic,
  user_id % 6 as part, sum(case when ts <= poll_ts then 1 else 0 end)::bigint as high_offset,
  nullif(sum(case when epoch_us(ts) + cast(round(value * 600) as bigint) * 1000000 <= epoch_us(poll_ts)
                  then 1 else 0 end), 0)::bigint as committed_offset
from (select distinct date_trunc('day', ts)::timestamp as poll_ts from events) p cross join events
group by 1, 2, 3, 4""",
    "spans": f"""
select user_id, {_SCENARIO} as scenario, epoch_us(ts) / 1e6 as start_sec,
  epoch_us(ts) / 1e6 + round(value * 600) as end_sec, epoch_us(ts) / 1e6 + round(value * 6) as short_end_sec
from events""",
    "attempts": """
select concat('m', cast(user_id as varchar), '-', cast(cast(ts as date) as varchar)) as uuid,
  epoch_us(ts) / 1e6 as ts, event_id, user_id % 6 as worker, event_type not in ('error', 'signup') as ok,
  row_number() over (partition by user_id, cast(ts as date) order by ts, event_id) as attempt,
  row_number() over (partition by user_id, cast(ts as date) order by ts, event_id) - 1 as retry_count
from events""",
    "runs": f"""
select split_part(l, '_', 1) as policy, split_part(l, '_', 2) as size, split_part(l, '_', 3) as dist,
  count(*) filter (where event_type = 'click') as hits, count(*) filter (where event_type = 'view') as misses,
  max(ts) as snapshot_ts
from (select *, {_RUN} as l from events) group by 1, 2, 3""",
}
