"""Lag, backlog, retries and message histories."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonetally.functions import columns as C
from zonetally.operators import backlog as B
from zonetally.operators import retries as R
from zonetally.plans.fixtures import attempts, offset_polls, spans
from zonetally.plans.registry import query, rounded

P, S, A = ("offset_polls",), ("spans",), ("attempts",)
LAG = "greatest(high_offset - greatest(coalesce(committed_offset, 0), 0), 0)"


@query("agg20_topic_lag", f"""
select strftime(poll_ts, '%Y-%m-%dT%H:%M:%S') as poll, topic, sum({LAG})::bigint as lag from offset_polls group by 1, 2""", P)
def _(spark, d):
    return B.topic_lag(offset_polls(spark, d)).select(C.iso("poll_ts").alias("poll"), "topic", "lag")


@query("agg21_total_lag", f"""
select strftime(poll_ts, '%Y-%m-%dT%H:%M:%S') as poll, topic, sum({LAG})::bigint as lag from offset_polls group by 1, 2
union all select strftime(poll_ts, '%Y-%m-%dT%H:%M:%S'), null, sum({LAG})::bigint from offset_polls group by 1""", P)
def _(spark, d):
    out = B.total_lag(offset_polls(spark, d), ["main", "retry"])
    return out.select(C.iso("poll_ts").alias("poll"), "topic", "lag")


@query("agg22_worker_counters", """
select worker, count(*) filter (where event_id % 97 <> 0 and ok) as processed, count(*) filter (where event_id % 97 <> 0 and not ok) as retried,
  count(*) filter (where event_id % 97 <> 0 and ok and retry_count > 0) as recovered,
  count(*) filter (where event_id % 97 <> 0 and not ok and retry_count + 1 >= 3) as to_dlq,
  count(*) filter (where event_id % 97 = 0) as errors from attempts group by 1""", A)
def _(spark, d):
    return R.worker_counters(attempts(spark, d), "worker", F.col("event_id") % 97 == 0)


def recovery_sql(key: str, end: str, source: str = "spans") -> str:
    """CTEs up to `health`: peak and recovery per key."""
    return f"""chg as (select k, t, sum(step) as step from (
  select {key} as k, start_sec as t, 1 as step from {source} union all select {key}, {end}, -1 from {source}) group by 1, 2),
bl as (select k, t, (sum(step) over (partition by k order by t))::bigint as total from chg),
pk as (select *, case when total > coalesce(max(total) over (partition by k order by t rows between unbounded preceding and 1 preceding), 0)
  then 1 else 0 end as np from bl),
g as (select *, sum(np) over (partition by k order by t) as gid from pk),
seg as (select k, gid, max(total) as pk, min(t) as pt, min(case when total = 0 then t end) as zt from g where gid > 0 group by 1, 2),
now as (select k, arg_max(total, t) as backlog_total from bl group by 1),
health as (select seg.k, any_value(backlog_total) as backlog_total, max(pk)::bigint as peak_backlog, arg_max(pt, gid) as peak_time,
  round(arg_max(zt - pt, gid) filter (where zt is not null), 2) as recovery_time_sec,
  max(gid) <> coalesce(max(gid) filter (where zt is not null), -1) as draining
  from seg join now on now.k = seg.k group by 1)"""


@query("win04_new_peaks", f"""
with {recovery_sql('user_id', 'end_sec')} select k as user_id, pk::bigint as peak, round(pt, 6) as peak_time from seg""", S)
def _(spark, d):
    flight = B.in_flight(spans(spark, d), "user_id", "start_sec", "end_sec")
    return rounded(B.new_peaks(flight, "user_id"), 6, "peak_time")


@query("win05_recovery_per_user", f"""
with {recovery_sql('user_id', 'end_sec')} select k as user_id, backlog_total, peak_backlog, round(peak_time, 6) as peak_time,
  recovery_time_sec, draining from health""", S)
def _(spark, d):
    flight = B.in_flight(spans(spark, d), "user_id", "start_sec", "end_sec")
    return rounded(B.recovery(flight, "user_id"), 6, "peak_time")


@query("win05_recovery_of_polls", f"""
with tot as (select poll_sec as t, topic, sum({LAG})::bigint as total from offset_polls group by 1, 2),
pk as (select *, case when total > coalesce(max(total) over (partition by topic order by t rows between unbounded preceding and 1 preceding), 0) then 1 else 0 end as np from tot)
select topic, max(total) as peak_backlog, max(case when np = 1 then t end) as peak_time from pk group by 1""", P)
def _(spark, d):
    lag = B.topic_lag(offset_polls(spark, d)).select("topic", F.unix_timestamp("poll_ts").cast("double").alias("t"), F.col("lag").alias("total"))
    return B.recovery(lag, "topic").select("topic", "peak_backlog", "peak_time")


@query("str06_routed_attempts_batch", """
select uuid, attempt, case when ok then 'metrics' when retry_count + 1 >= 3 then 'dead_letter' else 'retry' end as target,
  case when ok then retry_count else retry_count + 1 end as retry_count_after, ok and retry_count > 0 as is_recovered,
  not ok as is_retried, not ok and retry_count + 1 >= 3 as is_dead from attempts""", A)
def _(spark, d):
    return R.route(attempts(spark, d)).select(
        "uuid", "attempt", "target", "retry_count_after", "is_recovered", "is_retried", "is_dead")


HISTORY = """
with own as (select *, coalesce(sum(case when ok then 1 else 0 end) over (partition by uuid order by attempt rows between unbounded preceding and 1 preceding), 0) as done
  from attempts),
kept as (select * from own where done = 0 and attempt <= 3),
hist as (select uuid, case when bool_or(ok) then case when max(attempt) = 1 then 'ok' else 'recovered' end when max(attempt) >= 3 then 'dead_letter' else 'pending' end as state,
  max(attempt)::int as attempts, min(ts) as first_ts, max(ts) as last_ts from kept group by uuid)
"""


@query("str07_message_history_batch", HISTORY + "select uuid, state, attempts, round(first_ts, 6) as first_ts, round(last_ts, 6) as last_ts from hist", A)
def _(spark, d):
    return rounded(R.message_history(attempts(spark, d)), 6, "first_ts", "last_ts")


@query("prj13_end_to_end_latency", HISTORY + """
select uuid, round((last_ts - first_ts) * 1000, 2) as end_to_end_ms from hist where state in ('ok', 'recovered')""", A)
def _(spark, d):
    done = R.message_history(attempts(spark, d)).where(F.col("state").isin("ok", "recovered"))
    return rounded(done.select("uuid", R.end_to_end_ms(F.col("last_ts"), F.col("first_ts")).alias("end_to_end_ms")), 2, "end_to_end_ms")
