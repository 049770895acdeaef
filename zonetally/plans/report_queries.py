"""Snapshot documents and report tables over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonetally.functions import columns as C
from zonetally.functions import domains as D
from zonetally.operators import backlog as B
from zonetally.operators import kpis as K
from zonetally.operators import reports as R
from zonetally.plans.fixtures import query_events, runs, spans
from zonetally.plans.kpi_queries import RUNS, by_query_sql, events, evictions, summary_sql
from zonetally.plans.queue_queries import recovery_sql
from zonetally.plans.registry import query, rounded
from zonetally.session import scratch_path
from zonetally.sources.readers import read_snapshots
from zonetally.sources.writers import save_snapshots

E, ES = ("query_events",), ("query_events", "spans")
SUMMARY = f"with {summary_sql('run')}"
SCENARIO = f"""with scen as (select * from query_events where scenario <> 'base_sync' or event in ('hit', 'miss', 'error')),
{summary_sql('scenario', source='scen')}, work as (select * from spans where scenario <> 'base_sync'),
{recovery_sql('scenario', 'short_end_sec', 'work')}, doc as (select * from summary left join health on k = label)"""
ORDER = "(select unnest(range(0, 5)) as position, unnest(['base_sync', 'kafka_1c', 'kafka_3c', 'failure', 'spike']) as label) o"
GRID = """grid as (select p.policy, s.size, t.dist, concat_ws('_', p.policy, s.size, t.dist) as label
  from (select unnest(['LRU', 'LFU', 'FIFO']) as policy) p join (select unnest(['50mb', '200mb', '500mb']) as size) s on true
  join (select unnest(['zipf', 'uniform']) as dist) t on true)"""


def run_docs(spark, d):
    """A document per cell of the report grid."""
    return R.documents(K.run_facts(events(spark, d), "run", percentile_digits=4, runs=RUNS), None, "run")


def scenario_docs(spark, d):
    """A document per scenario; the synchronous one has neither consumers nor a queue."""
    sync = F.col("scenario") == "base_sync"
    e = events(spark, d).where(~sync | F.col("event").isin("hit", "miss", "error"))
    work = spans(spark, d, seconds_per_value=6).where(~sync)
    queue = B.recovery(B.in_flight(work, "scenario", "start_sec", "end_sec"), "scenario")
    return R.documents(K.run_facts(e, "scenario", percentile_digits=4, runs=D.SCENARIOS), queue, "scenario")


@query("set04_run_grid", f"with {GRID} select g.*, coalesce(hits, 0) + coalesce(misses, 0) as requests from grid g left join runs r on r.policy = g.policy and r.size = g.size and r.dist = g.dist", ("runs",))
def _(spark, d):
    done = runs(spark, d).select("policy", "size", "dist", (F.col("hits") + F.col("misses")).alias("n"))
    return R.run_grid(spark).join(done, ["policy", "size", "dist"], "left").select(
        "policy", "size", "dist", "label", F.coalesce("n", F.lit(0)).alias("requests"))


@query("jn07_combined_documents", SCENARIO + f""", {by_query_sql()},
q1 as (select label, any_value(total) filter (where query_type = 'Q1') as q1_total, count(*) as types from by_query group by 1)
select doc.label, hits, misses, total_requests, hit_rate, all_p95, processed, recovery_rate, peak_backlog, recovery_time_sec, draining, q1_total, types
from doc join q1 on q1.label = doc.label""", ES)
def _(spark, d):
    return scenario_docs(spark, d).select(
        "label", "totals.hits", "totals.misses", "totals.total_requests", "hit_rate", F.col("latency_ms_all.p95").alias("all_p95"),
        F.col("async_kpis.processed_total").alias("processed"), "async_kpis.recovery_rate", "queue_health.peak_backlog",
        "queue_health.recovery_time_sec", "queue_health.draining",
        F.element_at("by_query", "Q1")["total"].alias("q1_total"), F.size("by_query").cast("bigint").alias("types"))


@query("jn07_documents_with_evictions", """
with e as (select scenario, floor(ts / 86400) * 86400 as poll, count(*) as n from query_events where event = 'miss' group by 1, 2),
p as (select scenario, poll, (sum(n) over w)::bigint as total, n, lag(poll) over w as before from e window w as (partition by scenario order by poll)),
q as (select *, row_number() over (partition by scenario order by poll desc) as rn from p),
t as (select scenario, case when retry_count > 1 then 'retry' else 'main' end as topic, count(*) as lag from query_events where event = 'retry' group by 1, 2)
select scenario as label, total as total_evicted, round(n * 60::double / (poll - before), 2) as rate_per_min,
  (select max(lag) from t where t.scenario = q.scenario and topic = 'main') as main_lag, (select max(lag) from t where t.scenario = q.scenario and topic = 'retry') as retry_lag
from q where rn = 1""", E)
def _(spark, d):
    """Eviction counters and waiting messages by topic as parts of the documents."""
    polled = K.counter_rate(evictions(spark, d, "scenario"), "scenario", "poll_sec", "evicted", "rate_per_min")
    waiting = query_events(spark, d).where(F.col("event") == "retry").groupBy(
        "scenario", F.when(F.col("retry_count") > 1, "retry").otherwise("main").alias("topic")).agg(F.count(F.lit(1)).alias("lag"))
    work = spans(spark, d, seconds_per_value=6)
    queue = B.recovery(B.in_flight(work, "scenario", "start_sec", "end_sec"), "scenario")
    facts = K.run_facts(events(spark, d), "scenario", runs=D.SCENARIOS)
    docs = R.documents(facts, queue, "scenario", eviction=R.newest_eviction(polled, "scenario", "poll_sec"), lags=waiting)
    topics = F.col("queue_health.backlog_by_topic")
    return docs.select("label", "eviction.total_evicted", "eviction.rate_per_min",
                       topics["main"].alias("main_lag"), topics["retry"].alias("retry_lag"))


@query("prj12_nested_paths", SCENARIO + """
select label, coalesce(hit_rate, 0) as hit_rate, coalesce(e2e_p50, 0) as e2e_p50, coalesce(recovery_time_sec, 0) as recovery_time_sec,
  coalesce(peak_backlog, 0) as peak_backlog from doc""", ES)
def _(spark, d):
    return scenario_docs(spark, d).select(
        "label", C.path_or("hit_rate", 0.0).alias("hit_rate"), C.path_or("async_kpis.latency_e2e_ms.p50", 0.0).alias("e2e_p50"),
        C.path_or("queue_health.recovery_time_sec", 0.0).alias("recovery_time_sec"),
        C.path_or("queue_health.peak_backlog", 0).alias("peak_backlog"))


@query("prj15_safe_labels", """
select translate(concat(policy, '/', size, ' ', dist), '/ ', '__') as label, hits from runs""", ("runs",))
def _(spark, d):
    raw = F.concat(F.col("policy"), F.lit("/"), F.col("size"), F.lit(" "), F.col("dist"))
    return runs(spark, d).select(C.safe_label(raw).alias("label"), "hits")


@query("prj16_seconds", "select event_id, round(end_to_end_ms / 1000, 6) as end_to_end_sec from query_events where event = 'processed'", E)
def _(spark, d):
    done = query_events(spark, d).where(F.col("event") == "processed")
    return rounded(done.select("event_id", (F.col("end_to_end_ms") / 1000).alias("end_to_end_sec")), 6, "end_to_end_sec")


@query("flt06_scenarios_with_latency", SCENARIO + "select label from doc where e2e_p50 is not null", ES)
def _(spark, d):
    return R.scenario_latency(spark, scenario_docs(spark, d)).select("label")


@query("flt06_scenarios_with_backlog", SCENARIO + "select label from doc where peak_backlog > 0", ES)
def _(spark, d):
    return R.scenario_backlog(spark, scenario_docs(spark, d)).select("label")


@query("srt01_newest_document", f"with {summary_sql('run')} select label, hits, snapshot_ts from summary", E)
def _(spark, d):
    """Documents over the first half of the time are replaced by those over all of it."""
    e = events(spark, d)

    def docs(part):
        return K.run_totals(part, "run").select(
            F.col("run").alias("label"), "hits", F.col("as_of").alias("snapshot_ts"))

    return R.newest_per_label(docs(e).unionByName(docs(e.where(F.col("ts") < 1705276800.0))))


FIG1 = ["LRU_50mb_uniform", "LRU_50mb_zipf", "LFU_50mb_zipf", "FIFO_50mb_zipf"]
FIG7 = ["LRU_50mb_zipf", "LFU_50mb_zipf", "FIFO_50mb_zipf", "LRU_50mb_zipf_long"]


def _listed(labels):
    return f"(select unnest(range(0, {len(labels)})) as position, unnest({labels}) as label) l"


@query("rpt01_hit_rate_of_runs", SUMMARY + f"""
select position::int as position, l.label, coalesce(hit_rate, 0) as hit_rate from {_listed(FIG1)} left join summary s on s.label = l.label""", E)
def _(spark, d):
    return R.hit_rate_of(spark, run_docs(spark, d), FIG1)


def _pivot(value: str, by: str, values: list[str], where: str, prefix: str = "") -> str:
    cells = ", ".join(f"coalesce(max({value}) filter (where {by} = '{v}'), 0) as {prefix}{v}" for v in values)
    return f", {GRID} select policy, {cells} from grid left join summary using (label) where {where} group by policy"


@query("rpt02_hit_rate_by_distribution", SUMMARY + _pivot("hit_rate", "dist", D.DISTRIBUTIONS, "size = '50mb'"), E)
def _(spark, d):
    return R.hit_rate_by_distribution(spark, run_docs(spark, d))


@query("rpt03_hit_rate_by_size", SUMMARY + _pivot("hit_rate", "size", D.SIZES, "dist = 'zipf'", "size_"), E)
def _(spark, d):
    return R.hit_rate_by_size(spark, run_docs(spark, d))


THROUGHPUT = _pivot("throughput_qps_total", "dist", D.DISTRIBUTIONS, "size = '50mb'")


@query("rpt04_throughput_by_distribution", SUMMARY + THROUGHPUT.replace("select policy,", "select 60::double as target, policy,"), E)
def _(spark, d):
    return R.throughput_by_distribution(spark, run_docs(spark, d))


def _series(name: str, column: str) -> str:
    return f"select policy, '{name}' as series, coalesce(nullif({column}, 0), 0.01) as latency_ms from cells"


@query("rpt05_hit_and_miss_latency", SUMMARY + f""", {GRID}, cells as (select * from grid left join summary using (label) where size = '50mb' and dist = 'zipf')
{_series('p50_hit', 'hit_p50')} union all {_series('p95_hit', 'hit_p95')} union all {_series('p50_miss', 'miss_p50')} union all {_series('p95_miss', 'miss_p95')}""", E)
def _(spark, d):
    return R.hit_and_miss_latency(spark, run_docs(spark, d))


@query("rpt06_hit_rate_by_type", SUMMARY + f""", {by_query_sql()}
select query_type, coalesce(max(hit_rate) filter (where label = 'LRU_50mb_zipf'), 0) as "LRU_50mb_zipf",
  coalesce(max(hit_rate) filter (where label = 'LRU_50mb_uniform'), 0) as "LRU_50mb_uniform" from by_query group by 1""", E)
def _(spark, d):
    return R.hit_rate_by_type(spark, run_docs(spark, d), ["LRU_50mb_zipf", "LRU_50mb_uniform"])


@query("rpt07_time_saved", SUMMARY + f"""
select position::int as position, l.label, coalesce(cache_efficiency, 0) as saved_ms_per_request from {_listed(FIG7)} left join summary s on s.label = l.label""", E)
def _(spark, d):
    return R.time_saved_of(spark, run_docs(spark, d), FIG7)


@query("rpt08_scenario_throughput", SCENARIO + f"""
select position::int as position, o.label, coalesce(nullif(throughput_processed_qps_total, 0), nullif(throughput_qps_total, 0), 0) as throughput_qps
from {ORDER} join doc on doc.label = o.label""", ES)
def _(spark, d):
    return R.scenario_throughput(spark, scenario_docs(spark, d))


@query("rpt09_scenario_latency", SCENARIO + f"""
select position::int as position, o.label, round(e2e_p50 / 1000, 7) as p50_sec, round(e2e_p95 / 1000, 7) as p95_sec, round(e2e_p99 / 1000, 7) as p99_sec
from {ORDER} join doc on doc.label = o.label where e2e_p50 is not null""", ES)
def _(spark, d):
    return rounded(R.scenario_latency(spark, scenario_docs(spark, d)), 7, "p50_sec", "p95_sec", "p99_sec")


SCALING = SCENARIO + """, m as (
  select label, 'throughput_qps' as measure, throughput_processed_qps_total as value from doc union all select label, 'e2e_p50_sec', e2e_p50 / 1000 from doc
  union all select label, 'peak_backlog', peak_backlog::double from doc union all select label, 'recovery_time_sec', recovery_time_sec from doc)
select measure, round(max(value) filter (where label = 'kafka_1c'), 7) as consumers_1, round(max(value) filter (where label = 'kafka_3c'), 7) as consumers_3
from m group by 1"""


def _scaling(spark, d):
    return rounded(R.consumer_scaling(scenario_docs(spark, d)), 7, "consumers_1", "consumers_3")


query("rpt10_consumer_scaling", SCALING, ES)(_scaling)
query("jn08_scenarios_side_by_side", f"select measure, consumers_1, consumers_3 from ({SCALING}) where measure <> 'throughput_qps'", ES)(
    lambda spark, d: _scaling(spark, d).where(F.col("measure") != "throughput_qps"))


def _measure(name: str, column: str) -> str:
    return f"select '{name}' as measure, {column}::double as value from doc where label = 'failure'"


@query("rpt11_fault_measures", SCENARIO + " " + " union all ".join(_measure(n, c) for n, c in [
    ("retry_rate", "retry_rate"), ("recovery_rate", "recovery_rate"), ("dlq_rate", "dlq_rate"), ("retried", "retried"),
    ("recovered", "recovered"), ("dlq", "dead_lettered"), ("peak_backlog", "peak_backlog")]), ES)
def _(spark, d):
    return R.fault_measures(scenario_docs(spark, d))


@query("rpt12_scenario_backlog", SCENARIO + f"""
select position::int as position, o.label, peak_backlog, coalesce(recovery_time_sec, 0) as recovery_time_sec
from {ORDER} join doc on doc.label = o.label where peak_backlog > 0""", ES)
def _(spark, d):
    return R.scenario_backlog(spark, scenario_docs(spark, d))


@query("src05_snapshot_files", SCENARIO + """
select label, hits, hit_rate, e2e_p95, peak_backlog from doc""", ES)
def _(spark, d):
    """Half of the documents are stored at the root of their file, half under `summary`."""
    path = scratch_path(spark, "snapshots")
    docs = scenario_docs(spark, d)
    wrapped = F.col("label").isin("base_sync", "failure")
    body = [c for c in docs.columns if c != "label"]
    save_snapshots(docs.where(~wrapped), f"{path}/root")
    save_snapshots(docs.where(wrapped).select("label", F.struct("label", *body).alias("summary")), f"{path}/wrapped")
    return read_snapshots(spark, f"{path}/root", f"{path}/wrapped").select(
        "label", "totals.hits", "hit_rate", F.col("async_kpis.latency_e2e_ms.p95").alias("e2e_p95"), "queue_health.peak_backlog")


@query("snk04_replaced_snapshots", f"with {summary_sql('run')} select label, hits from summary", E)
def _(spark, d):
    """A second save of two labels replaces them and leaves the other labels."""
    path = scratch_path(spark, "labelled")
    totals = K.run_totals(events(spark, d), "run").select(F.col("run").alias("label"), F.struct("hits").alias("totals"))
    again = F.col("label").isin("LRU_50mb_zipf", "LFU_50mb_zipf")
    wrong = F.struct((F.col("totals.hits") * 0).alias("hits"))
    save_snapshots(totals.withColumn("totals", F.when(again, wrong).otherwise(F.col("totals"))), path)
    save_snapshots(totals.where(again), path)
    return read_snapshots(spark, path).select("label", "totals.hits")
