"""Telemetry KPIs."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonetally import schemas
from zonetally.functions import columns as C
from zonetally.functions import domains as D
from zonetally.operators import kpis as K
from zonetally.operators import prefix
from zonetally.operators import sketches as SK
from zonetally.operators.newest import newest_of_few, newest_of_many, newest_overall
from zonetally.operators.percentiles import exact_percentiles
from zonetally.plans.fixtures import query_events, table
from zonetally.plans.registry import query, rounded
from zonetally.session import store
from zonetally.sources.readers import parse_json, read_events, together

E = ("query_events",)
RUNS = [f"{p}_{s}_{t}" for p in D.POLICIES for s in D.SIZES for t in D.DISTRIBUTIONS]
NOW = 1706659200.0  # a fixed clock for events without a time


def events(spark, d):
    return K.normalise(query_events(spark, d), NOW)


def norm_sql(group: str, source: str = "query_events") -> str:
    return f"""norm as (select event_id, ts, event, upper(coalesce(nullif(query_type, ''), 'UNK')) as query_type,
  coalesce(latency_ms, 0::double) as latency_ms, end_to_end_ms, from_retry, retry_count, cache, worker, user_id, {group} as label
  from {source})"""


COUNTERS = """count(*) filter (where event = 'hit') as hits, count(*) filter (where event = 'miss') as misses,
  count(*) filter (where event = 'error') as errors, count(*) filter (where event = 'processed') as processed,
  count(*) filter (where event = 'retry') as retried,
  count(*) filter (where (event = 'processed' and from_retry) or event = 'recovered') as recovered,
  count(*) filter (where event = 'dlq') as dead_lettered"""


def _three(value: str, name: str, cond: str = "true", suffix: str = "") -> str:
    return ", ".join(
        f"round(quantile_cont({value}, {p}) filter (where {cond}), 4) as {name}{n}{suffix}"
        for n, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)))


def sample_sql(lw: int | None = None, tw: int | None = None) -> str:
    """CTE `smp`: all rows of every list, or the newest of each if numbers are given."""
    answered = "event in ('hit', 'miss')"
    cut = "" if lw is None else "where rn <= lim"
    return f"""listed as (
  select label, event as kind, ts, event_id, latency_ms as v, {lw or 0} as lim from norm where {answered}
  union all select label, query_type, ts, event_id, latency_ms, {lw or 0} from norm
    where {answered} and query_type in ('Q1', 'Q2', 'Q3', 'Q4', 'Q5')
  union all select label, 'requests', ts, event_id, ts, {tw or 0} from norm where {answered}
  union all select label, 'processed', ts, event_id, ts, {tw or 0} from norm where event = 'processed'
  union all select label, 'e2e', ts, event_id, end_to_end_ms, {lw or 0} from norm where event = 'processed' and end_to_end_ms is not null),
smp as (select * from (select *, row_number() over (partition by label, kind order by ts desc, event_id desc) as rn from listed) {cut})"""


def summary_sql(group: str, source: str = "query_events") -> str:
    """CTEs up to `summary`: one flat row of KPIs per label."""
    return f"""{norm_sql(group, source)}, {sample_sql()},
totals as (select label, {COUNTERS}, min(ts) as start_ts, max(ts) as as_of from norm group by label),
lat as (select label, {_three('v', 'hit_', "kind = 'hit'")}, {_three('v', 'miss_', "kind = 'miss'")},
  {_three('v', 'all_', "kind in ('hit', 'miss')")}, {_three('v', 'e2e_', "kind = 'e2e'")},
  coalesce(avg(v) filter (where kind = 'hit'), 0) as mean_hit, coalesce(avg(v) filter (where kind = 'miss'), 0) as mean_miss
  from smp group by label),
rec as (select s.label, count(*) filter (where kind = 'requests' and ts >= as_of - 10) / 10 as r,
  count(*) filter (where kind = 'processed' and ts >= as_of - 10) / 10 as p from smp s join totals using (label) group by 1),
summary as (select label, round(as_of - start_ts, 2) as elapsed_sec, hits, misses, errors, hits + misses as total_requests,
  case when hits + misses > 0 then round(hits / (hits + misses), 4) end as hit_rate,
  case when hits + misses > 0 then round(1 - hits / (hits + misses), 4) end as miss_rate,
  round(case when as_of > start_ts then (hits + misses) / (as_of - start_ts) else 0 end, 2) as throughput_qps_total,
  round(coalesce(r, 0), 2) as throughput_qps_recent_10s,
  hit_p50, hit_p95, hit_p99, miss_p50, miss_p95, miss_p99, all_p50, all_p95, all_p99, e2e_p50, e2e_p95, e2e_p99,
  round(coalesce(mean_hit, 0), 3) as mean_t_cache_ms, round(coalesce(mean_miss, 0), 3) as mean_t_db_ms,
  case when hits + misses > 0 and mean_miss > 0 then round(hits * (mean_miss - mean_hit) / (hits + misses), 3) end as cache_efficiency,
  processed, recovered, retried, dead_lettered,
  round(case when as_of > start_ts then processed / (as_of - start_ts) else 0 end, 2) as throughput_processed_qps_total,
  round(coalesce(p, 0), 2) as throughput_processed_qps_recent_10s,
  case when processed + dead_lettered > 0 then round(retried / (processed + dead_lettered), 4) end as retry_rate,
  case when processed + dead_lettered > 0 then round(dead_lettered / (processed + dead_lettered), 4) end as dlq_rate,
  case when recovered + dead_lettered > 0 then round(recovered / (recovered + dead_lettered), 4) end as recovery_rate,
  as_of as snapshot_ts
  from totals left join lat using (label) left join rec using (label))"""


def by_query_sql() -> str:
    """CTE after `smp`: the per-type block."""
    return f"""byq as (select l.label, q.query_type, count(*) filter (where event = 'hit') as hits,
  count(*) filter (where event = 'miss') as misses
  from (select distinct label from norm) l
  join (select unnest(['Q1', 'Q2', 'Q3', 'Q4', 'Q5']) as query_type) q on true
  left join norm n on n.label = l.label and n.query_type = q.query_type group by 1, 2),
byqp as (select label, kind as query_type, {_three('v', '', suffix='_ms')} from smp where kind like 'Q%' group by 1, 2),
by_query as (select label, query_type, hits, misses, hits + misses as total,
  case when hits + misses > 0 then round(hits / (hits + misses), 4) end as hit_rate, p50_ms, p95_ms, p99_ms
  from byq left join byqp using (label, query_type))"""


# Interpolated values of two-decimal inputs have at most four decimals, so four digits
# only remove noise; at three digits an exact half may go either way.

# ---- projections and routing -------------------------------------------------

@query("prj04_metric_records", """
select ts, upper(coalesce(nullif(query_type, ''), 'UNK')) as query_type, cache, end_to_end_ms as latency_ms,
  coalesce(retry_count, 0)::int as retry_count, 'processed' as status from query_events where event = 'processed'""", E)
def _(spark, d):
    return K.metric_records(query_events(spark, d))


@query("prj06_normalised_events", f"with {norm_sql('all_runs')} select event_id, query_type, latency_ms, ts from norm", E)
def _(spark, d):
    return events(spark, d).select("event_id", "query_type", "latency_ms", "ts")


@query("prj01_parse_payload", """
select ts, upper(coalesce(nullif(query_type, ''), 'UNK')) as query_type, cache, end_to_end_ms as latency_ms,
  coalesce(retry_count, 0)::int as retry_count, 'processed' as status
from query_events where event = 'processed' and event_id % 97 <> 0
union all select null, null, null, null, null, null from query_events where event = 'processed' and event_id % 97 = 0""", E)
def _(spark, d):
    return parse_json(payloads(spark, d), schemas.METRIC_RECORD)


def payloads(spark, d):
    """Metric records as JSON text, every 97th event unreadable."""
    e = query_events(spark, d).where(F.col("event") == "processed")
    text = F.to_json(F.struct(
        "ts", C.normal_type().alias("query_type"), "cache", F.col("end_to_end_ms").alias("latency_ms"),
        F.coalesce("retry_count", F.lit(0)).alias("retry_count"), F.lit("processed").alias("status")))
    return e.select("event_id", F.when(F.col("event_id") % 97 == 0, "garbage").otherwise(text).alias("value"))


@query("prj02_event_time", """
select event_id, strftime(make_timestamp(cast(round(ts * 1e6) as bigint)), '%Y-%m-%dT%H:%M:%S') as at from query_events""", E)
def _(spark, d):
    return query_events(spark, d).select("event_id", C.iso(C.event_time()).alias("at"))


@query("src04_event_json", """
select event, query_type, latency_ms, end_to_end_ms, from_retry, retry_count::int as retry_count, cache, ts
from query_events where event is not null""", E)
def _(spark, d):
    e = query_events(spark, d)
    names = [f.name for f in schemas.EVENT.fields if f.name in e.columns]
    text = e.select(F.to_json(F.struct(*names)).alias("value"))
    return read_events(text).select("event", "query_type", "latency_ms", "end_to_end_ms", "from_retry", "retry_count", "cache", "ts")


@query("flt05_event_routing", f"select all_runs, {COUNTERS} from query_events group by 1", E)
def _(spark, d):
    return query_events(spark, d).groupBy("all_runs").agg(*K.counters())


@query("agg07_event_counters", f"select run, {COUNTERS} from query_events group by 1", E)
def _(spark, d):
    return query_events(spark, d).groupBy("run").agg(*K.counters())


@query("str08_running_counters_batch", "select event, count(*) as n from query_events where ts >= 1705000000 group by 1", E)
def _(spark, d):
    return K.running_counters(query_events(spark, d), since=1705000000.0)


# ---- by type, percentiles, means, rates --------------------------------------

@query("agg08_by_query_type", f"with {norm_sql('scenario')}, {sample_sql()}, {by_query_sql()} select * from by_query", E)
def _(spark, d):
    facts = K.run_facts(events(spark, d), "scenario", percentile_digits=4, runs=D.SCENARIOS)
    return K.by_query_type(facts, "scenario").withColumnRenamed("scenario", "label")


@query("jn06_dense_query_types", f"with {norm_sql('run')}, {sample_sql()}, {by_query_sql()} select label, query_type, hits, misses, total, hit_rate from by_query", E)
def _(spark, d):
    return K.by_query_type(K.run_facts(events(spark, d), "run", runs=RUNS), "run").select(
        F.col("run").alias("label"), "query_type", "hits", "misses", "total", "hit_rate")


@query("agg09_exact_percentiles", f"""
select event_type, count(*) as n, {_three('value', '')} from events group by 1""")
def _(spark, d):
    return exact_percentiles(table(spark, d, "events"), ["event_type"], "value", digits=4)


@query("agg09_sample_percentiles", f"""
with {norm_sql('scenario')}, {sample_sql()} select label, kind, {_three('v', '')} from smp where kind in ('hit', 'miss', 'e2e') group by 1, 2""", E)
def _(spark, d):
    out = exact_percentiles(_listed(spark, d, "hit", "miss", "e2e"), ["scenario", "kind"], "value", digits=4, weight="n")
    return out.withColumnRenamed("scenario", "label").drop("n")


def _listed(spark, d, *kinds):
    e = events(spark, d)
    counted = K.counted_values(e, "scenario", K.run_totals(e, "scenario"))
    return K.latency_lists(counted).where(F.col("kind").isin(*kinds))


@query("agg10_pooled_percentiles", f"""
with {norm_sql('scenario')}, {sample_sql()} select label, count(*) as n, {_three('v', '')}
from smp where kind in ('hit', 'miss') group by 1""", E)
def _(spark, d):
    out = exact_percentiles(_listed(spark, d, "all"), ["scenario"], "value", digits=4, weight="n")
    return out.withColumnRenamed("scenario", "label")


@query("set01_pooled_samples", f"""
with {norm_sql('scenario')}, {sample_sql()} select label, event_id, kind, v as value from smp where kind in ('hit', 'miss')""", E)
def _(spark, d):
    e = events(spark, d).select(F.col("scenario").alias("label"), "event_id", F.col("event").alias("kind"), F.col("latency_ms").alias("value"))
    return e.where(F.col("kind") == "hit").unionByName(e.where(F.col("kind") == "miss"))


@query("agg11_mean_latencies", f"""
with {summary_sql('run')} select label as run, mean_t_cache_ms, mean_t_db_ms from summary""", E)
def _(spark, d):
    return K.run_summary(K.run_facts(events(spark, d), "run", runs=RUNS), "run").select("run", "mean_t_cache_ms", "mean_t_db_ms")


@query("agg12_hit_rates", """
select run, case when count(*) filter (where event in ('hit', 'miss')) > 0 then round(count(*) filter (where event = 'hit') / count(*) filter (where event in ('hit', 'miss')), 4) end as hit_rate,
  case when count(*) filter (where event in ('hit', 'miss')) > 0 then round(1 - count(*) filter (where event = 'hit') / count(*) filter (where event in ('hit', 'miss')), 4) end as miss_rate
from query_events group by 1""", E)
def _(spark, d):
    counts = query_events(spark, d).groupBy("run").agg(*K.counters())
    return counts.select("run", *K.hit_rates(F.col("hits"), F.col("misses")))


@query("agg13_time_saved", f"with {summary_sql('run')} select label as run, cache_efficiency from summary", E)
def _(spark, d):
    return K.run_summary(K.run_facts(events(spark, d), "run", runs=RUNS), "run").select("run", "cache_efficiency")


@query("agg14_throughput", """
select run, count(*) as n, round(case when max(ts) > min(ts) then count(*) / (max(ts) - min(ts)) else 0 end, 6) as qps
from query_events where event in ('hit', 'miss') group by 1""", E)
def _(spark, d):
    answered = query_events(spark, d).where(F.col("event").isin("hit", "miss"))
    n = F.count(F.lit(1))
    return rounded(answered.groupBy("run").agg(n.alias("n"), K.throughput(n, F.min("ts"), F.max("ts")).alias("qps")), 6, "qps")


@query("agg15_recent_throughput", f"""
with {norm_sql('run')}, {sample_sql()}, t as (select label, max(ts) as as_of from norm group by 1)
select s.label as run, round(count(*) filter (where ts >= as_of - 86400) / 86400, 8) as qps
from smp s join t using (label) where kind = 'requests' group by 1""", E)
def _(spark, d):
    e = events(spark, d)
    return rounded(K.recent_rate(e, "run", K.run_totals(e, "run"), 86400.0), 8, "qps")


@query("agg16_finish_rates", f"""
with {summary_sql('run')} select label as run, retry_rate, dlq_rate, recovery_rate from summary""", E)
def _(spark, d):
    return query_events(spark, d).groupBy("run").agg(*K.counters()).select("run", *K.finish_rates())


@query("agg16_run_summary", f"with {summary_sql('run')} select label as run, * exclude (label) from summary", E)
def _(spark, d):
    facts = K.run_facts(events(spark, d), "run", percentile_digits=4, runs=RUNS)
    return K.run_summary(facts, "run")


# ---- sliding windows ---------------------------------------------------------

WINDOWS = """
with rec as (select make_timestamp(cast(round(ts * 1e6) as bigint)) as t, end_to_end_ms as latency_ms, cache, retry_count
  from query_events where event = 'processed'),
win as (select unnest([time_bucket(interval 30 minutes, t), time_bucket(interval 30 minutes, t) - interval 30 minutes]) as w, * from rec)
"""
WINDOW_ROWS = """select strftime(w, '%Y-%m-%dT%H:%M:%S') as window_start, strftime(w + interval 1 hour, '%Y-%m-%dT%H:%M:%S') as window_end,
  count(*) as events_in_window, quantile_disc(latency_ms, 0.5) as p50_ms, quantile_disc(latency_ms, 0.95) as p95_ms,
  round(avg(case when cache = 'HIT' then 1::double else 0 end), 6) as hit_rate,
  round(avg(case when retry_count > 0 then 1::double else 0 end), 6) as retried_share from win group by w"""


def windowed(spark, d):
    records = K.metric_records(query_events(spark, d)).withColumn("event_time", C.event_time())
    return K.window_kpis(records, length="1 hour", slide="30 minutes")


def iso_windows(df):
    out = df.withColumns({c: C.iso(c) for c in ("window_start", "window_end")})
    return rounded(out, 6, "hit_rate", "retried_share")


@query("agg17_sliding_kpis", WINDOWS + WINDOW_ROWS, E)
def _(spark, d):
    return iso_windows(windowed(spark, d))


PANE = 1800


def stored_panes(spark, d):
    records = K.metric_records(query_events(spark, d)).withColumn("event_time", C.event_time())
    return store(spark, SK.window_panes(records, seconds=PANE), "panes")


@query("agg17_windows_from_panes", WINDOWS + WINDOW_ROWS, E)
def _(spark, d):
    return iso_windows(SK.windows_of_panes(stored_panes(spark, d), PANE, 3600, 1800))


OTHER_LENGTHS = ((3600 * 2, 1800), (3600 * 6, 3600 * 3), (86400, 86400))
OTHER_WINDOWS = """
with rec as (select make_timestamp(cast(round(ts * 1e6) as bigint)) as t, end_to_end_ms as latency_ms, cache, retry_count
  from query_events where event = 'processed'),
len(length, slide) as (values """ + ", ".join(f"({a}, {b})" for a, b in OTHER_LENGTHS) + """),
win as (select length, to_timestamp(cast(floor(epoch(t) / slide) as bigint) * slide - k * slide)::timestamp as w, rec.*
  from rec, len, range(48) r(k) where k < length / slide)
select length, strftime(w, '%Y-%m-%dT%H:%M:%S') as window_start, count(*) as events_in_window,
  quantile_disc(latency_ms, 0.5) as p50_ms, quantile_disc(latency_ms, 0.95) as p95_ms,
  round(avg(case when cache = 'HIT' then 1::double else 0 end), 6) as hit_rate from win group by length, w"""


@query("agg17_other_lengths_from_panes", OTHER_WINDOWS, E)
def _(spark, d):
    """Windows of three lengths out of one table of panes; the events are read once, for the panes."""
    panes = stored_panes(spark, d)
    kpis = [SK.windows_of_panes(panes, PANE, length, slide).select(
        F.lit(length).alias("length"), C.iso("window_start").alias("window_start"), "events_in_window", "p50_ms", "p95_ms", "hit_rate")
        for length, slide in OTHER_LENGTHS]
    return rounded(together(*kpis), 6, "hit_rate")


@query("prj03_window_bounds", WINDOWS + """select strftime(w, '%Y-%m-%dT%H:%M:%S') as window_start,
  strftime(w + interval 1 hour, '%Y-%m-%dT%H:%M:%S') as window_end, count(*) as n from win group by w""", E)
def _(spark, d):
    records = K.metric_records(query_events(spark, d)).withColumn("event_time", C.event_time())
    return records.groupBy(F.window("event_time", "1 hour", "30 minutes")).agg(F.count(F.lit(1)).alias("n")).select(
        C.iso("window.start").alias("window_start"), C.iso("window.end").alias("window_end"), "n")


@query("prj10_window_doc_id", WINDOWS + """select strftime(w, '%Y-%m-%dT%H-%M-%S') || '_' || strftime(w + interval 1 hour, '%Y-%m-%dT%H-%M-%S') as doc_id,
  count(*) as events_in_window from win group by w""", E)
def _(spark, d):
    return windowed(spark, d).select(C.window_doc_id("window_start", "window_end").alias("doc_id"), "events_in_window")


@query("agg18_conditional_share", """
select run, round(avg(case when cache = 'HIT' then 1::double else 0 end), 6) as hit_rate,
  round(avg(case when retry_count > 0 then 1::double else 0 end), 6) as retried_share,
  round(avg(case when latency_ms > 50 then 1::double else 0 end), 6) as slow_share
from query_events group by 1""", E)
def _(spark, d):
    out = query_events(spark, d).groupBy("run").agg(
        C.share(F.col("cache") == "HIT").alias("hit_rate"), C.share(F.col("retry_count") > 0).alias("retried_share"),
        C.share(F.col("latency_ms") > 50).alias("slow_share"))
    return rounded(out, 6, "hit_rate", "retried_share", "slow_share")


@query("agg19_approximate_percentiles", """
select event_type, quantile_disc(value, 0.5) as p50, quantile_disc(value, 0.95) as p95 from events group by 1""")
def _(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(
        F.percentile_approx("value", 0.5, 1000000).alias("p50"), F.percentile_approx("value", 0.95, 1000000).alias("p95"))


@query("agg19_merged_sketches", """
select event_type, count(*) as n, true as p50_within_1_percent, true as p95_within_1_percent, true as p99_within_1_percent from events group by 1""")
def _(spark, d):
    """Sketches of days, stored and merged by type: whether the ranks of their percentiles among all values are right to 1 %."""
    e = table(spark, d, "events").select("event_type", "value", F.to_date("ts").alias("day"))
    days = store(spark, e.groupBy("event_type", "day").agg(SK.quantile_sketch("value").alias("values")), "sketches")
    shares = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    found = days.groupBy("event_type").agg(SK.merged_quantiles("values").alias("values")).select(
        "event_type", F.kll_sketch_get_n_double("values").alias("n"), *[SK.quantile("values", q).alias(p) for p, q in shares.items()])
    ranks = e.join(F.broadcast(found), "event_type").groupBy("event_type", "n").agg(*[
        F.struct(F.avg((F.col("value") < F.col(p)).cast("int")).alias("below"), F.avg((F.col("value") <= F.col(p)).cast("int")).alias("to")).alias(p)
        for p in shares])
    return ranks.select("event_type", "n", *[
        ((F.col(f"{p}.below") <= q + 0.01) & (F.col(f"{p}.to") >= q - 0.01)).alias(f"{p}_within_1_percent") for p, q in shares.items()])


# ---- ordered windows ---------------------------------------------------------

@query("win01_newest_per_list", f"""
with {norm_sql('scenario')}, {sample_sql(300, 700)} select label, kind, event_id, v as value from smp""", E)
def _(spark, d):
    return K.samples(events(spark, d), "scenario", 300, 700, few_runs=True).select(F.col("scenario").alias("label"), "kind", "event_id", "value")


@query("win01_newest_per_kind", """
select event, event_id from (select *, row_number() over (partition by event order by ts desc, event_id desc) as rn from query_events
  where event in ('hit', 'miss')) where rn <= 500""", E)
def _(spark, d):
    e = query_events(spark, d).select("event", "event_id", "ts")
    return newest_of_few(e, "event", ["hit", "miss"], "ts", "event_id", 500).select("event", "event_id")


@query("win01_newest_per_user", """
select user_id, event_id from (select user_id, event_id, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
  from query_events) where rn <= 20""", E)
def _(spark, d):
    return newest_of_many(query_events(spark, d), ["user_id"], "ts", "event_id", 20).select("user_id", "event_id")


@query("win02_newest_hit_rate", """
with last as (select *, row_number() over (partition by worker order by ts desc, event_id desc) as rn from query_events)
select worker, count(*) as window_size, round(count(*) filter (where cache = 'HIT') / count(*), 4) as hit_rate_window
from last where rn <= 200 group by 1""", E)
def _(spark, d):
    return K.newest_hit_rate(query_events(spark, d), "worker")


@query("srt02_newest_results", """
select event_id, cache from (select *, row_number() over (order by ts desc, event_id desc) as rn from query_events) where rn <= 200""", E)
def _(spark, d):
    return newest_overall(query_events(spark, d), "ts", "event_id", 200).select("event_id", "cache")


def evictions(spark, d, by="worker"):
    """Daily polls of a counter that only grows, per worker (or run)."""
    e = query_events(spark, d).where(F.col("event") == "miss")
    daily = e.groupBy(by, (F.floor(F.col("ts") / 86400.0) * 86400.0).cast("double").alias("poll_sec")).agg(F.count(F.lit(1)).alias("_n"))
    return prefix.running_sum(daily, [by], ["poll_sec"], F.col("_n"), "evicted").drop("_n")


@query("win03_counter_rate", """
with daily as (select worker, floor(ts / 86400) * 86400 as poll_sec, count(*) as n from query_events where event = 'miss' group by 1, 2),
polls as (select worker, poll_sec, (sum(n) over (partition by worker order by poll_sec))::bigint as evicted from daily)
select worker, poll_sec, evicted, round((evicted - lag(evicted) over w) * 60.0::double / (poll_sec - lag(poll_sec) over w), 2) as rate_per_min
from polls window w as (partition by worker order by poll_sec)""", E)
def _(spark, d):
    return K.counter_rate(evictions(spark, d), "worker", "poll_sec", "evicted", "rate_per_min")


@query("win07_rolling_count", """
select event_id, count(*) over (partition by event order by cast(round(ts * 1e6) as bigint) range between 3600000000 preceding and current row) as n_last_hour
from query_events where event is not null""", E)
def _(spark, d):
    e = query_events(spark, d).where(F.col("event").isNotNull())
    return prefix.rolling_count(e, ["event"], "ts", 3600.0, "n_last_hour").select("event_id", "n_last_hour")
