"""KPIs of answered requests: counters, rates, percentiles, throughput."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonetally.functions import columns as C
from zonetally.functions import domains as D
from zonetally.operators import prefix
from zonetally.operators.newest import newest_of_many
from zonetally.operators.percentiles import P50_95_99, exact_percentiles, same_group
from zonetally.session import store


def normalise(events: DataFrame, now: float | None = None) -> DataFrame:
    """Defaults of raw events: type UNK, latency 0, missing or zero time is `now`."""
    clock = F.unix_micros(F.current_timestamp()) / F.lit(1e6) if now is None else F.lit(float(now))
    return (
        events.withColumn("query_type", C.normal_type())
        .withColumn("latency_ms", F.coalesce("latency_ms", F.lit(0.0)))
        .withColumn("ts", F.coalesce(F.nullif(F.col("ts"), F.lit(0.0)), clock))
    )


def metric_records(events: DataFrame) -> DataFrame:
    """Records of the processed events, as the windowed KPIs read them."""
    return events.where(F.col("event") == "processed").select(
        "ts", C.normal_type().alias("query_type"), "cache",
        F.col("end_to_end_ms").alias("latency_ms"),
        F.coalesce("retry_count", F.lit(0)).cast("int").alias("retry_count"),
        F.lit("processed").alias("status"),
    )


# What each counter counts. Unknown kinds of events count nowhere.
COUNTERS = {
    "hits": "event = 'hit'",
    "misses": "event = 'miss'",
    "errors": "event = 'error'",
    "processed": "event = 'processed'",
    "retried": "event = 'retry'",
    "recovered": "(event = 'processed' and from_retry) or event = 'recovered'",
    "dead_lettered": "event = 'dlq'",
}


def counters() -> list[Column]:
    return [F.expr(f"count_if({condition}) as {name}") for name, condition in COUNTERS.items()]


def hit_rates(hits: Column, misses: Column, digits: int | None = 4) -> list[Column]:
    """Hit and miss rate, null without requests."""
    rate = C.ratio(hits, hits + misses)
    out = {"hit_rate": rate, "miss_rate": 1 - rate}
    return [(v if digits is None else F.round(v, digits)).alias(k) for k, v in out.items()]


def finish_rates(digits: int = 4) -> list[Column]:
    """Rates of retried, dead-lettered and recovered messages; null on empty bases."""
    done = F.col("processed") + F.col("dead_lettered")
    failed = F.col("recovered") + F.col("dead_lettered")
    return [
        C.ratio(F.col("retried"), done, digits).alias("retry_rate"),
        C.ratio(F.col("dead_lettered"), done, digits).alias("dlq_rate"),
        C.ratio(F.col("recovered"), failed, digits).alias("recovery_rate"),
    ]


def time_saved(hits: Column, total: Column, mean_hit: Column, mean_miss: Column) -> Column:
    """Milliseconds saved per request by reuse; null without requests or misses."""
    return F.when((total > 0) & (mean_miss > 0), F.round(hits * (mean_miss - mean_hit) / total, 3))


def throughput(count: Column, start: Column, end: Column) -> Column:
    """Rows per second over a span; 0 for an empty span."""
    return F.when(end > start, count / (end - start)).otherwise(0.0)


LATENCY_LISTS = ["hit", "miss", *D.QUERY_TYPES, "e2e"]
TIME_LISTS = ["requests", "processed"]

# Which lists an event belongs to.
ANSWERED = "event in ('hit', 'miss')"
MEMBERS = {
    "hit": "event = 'hit'",
    "miss": "event = 'miss'",
    **{q: f"{ANSWERED} and query_type = '{q}'" for q in D.QUERY_TYPES},
    "e2e": "event = 'processed' and _e2e",
    "requests": ANSWERED,
    "processed": "event = 'processed'",
}


def samples(events: DataFrame, group: str, latency_window: int, times_window: int, slot_seconds: float = 60.0, few_runs: bool = False) -> DataFrame:
    """The newest rows of every list: (group, kind, ts, event_id, value).

    Kinds: hit, miss, Q1..Q5 and e2e keep so many latencies, requests and processed
    so many times; KPIs of whole runs don't use this. Works as `newest_of_few` does, for all lists at once: events are counted
    per time slot, the counts give each list of a group its first slot, and only
    events from such slots on are put into lists. The table of first slots has one
    row per run; `few_runs` says that a fixed list bounds them, so it may be broadcast.
    """
    limits = {k: latency_window for k in LATENCY_LISTS} | {k: times_window for k in TIME_LISTS}
    relevant = events.where(f"{ANSWERED} or event = 'processed'").select(
        group, "event", "query_type", "ts", "event_id", "latency_ms", "end_to_end_ms",
        F.expr(f"floor(ts / {float(slot_seconds)}D) as _slot"), F.expr("end_to_end_ms is not null as _e2e"))

    def lists(also: dict[str, str]) -> Column:
        entries = ", ".join(
            f"case when {condition} and {also.get(k, 'true')} then struct('{k}' as kind, {limits[k]} as _limit) end"
            for k, condition in MEMBERS.items())
        return F.expr(f"inline(array_compact(array({entries})))")

    newer = Window.partitionBy(group, "kind").orderBy(F.desc("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        relevant.groupBy(group, "event", "query_type", "_e2e", "_slot").agg(F.count(F.lit(1)).alias("_n"))
        .select(group, "_slot", "_n", lists({}))
        .groupBy(group, "kind", "_limit", "_slot").agg(F.sum("_n").alias("_n"))
        .withColumn("_newer", F.coalesce(F.sum("_n").over(newer), F.lit(0))).where("_newer < _limit")
        .groupBy(group).agg(*[F.expr(f"min(case when kind = '{k}' then _slot end) as _cut_{k}") for k in limits])
    )
    recent = {k: f"_slot >= _cut_{k}" for k in limits}
    newest = Window.partitionBy(group, "kind").orderBy(F.desc("ts"), F.desc("event_id"))
    return (
        relevant.join(F.broadcast(cuts) if few_runs else cuts, group)
        .where(" or ".join(f"({MEMBERS[k]} and {recent[k]})" for k in limits))
        .select(group, "ts", "event_id", "latency_ms", "end_to_end_ms", lists(recent))
        .select(group, "kind", "ts", "event_id", "_limit",
                F.expr("case when kind in ('requests', 'processed') then ts when kind = 'e2e' then end_to_end_ms"
                       " else latency_ms end as value"),
                F.row_number().over(newest).alias("_rn"))
        .where("_rn <= _limit").drop("_limit", "_rn")
    )


RECENT_SECONDS = 10.0


def recent_counts(events: DataFrame, group: str, totals: DataFrame, seconds: float = RECENT_SECONDS) -> DataFrame:
    """The events with `_recent`: whether they lie in the last seconds before their run's `as_of`."""
    ends = same_group(events, totals.select(group, "as_of"), [group])
    return ends.withColumn("_recent", F.col("ts") >= F.col("as_of") - F.lit(float(seconds))).drop("as_of")


def recent_rate(events: DataFrame, group: str, totals: DataFrame, seconds: float = RECENT_SECONDS) -> DataFrame:
    """(group, qps): answers per second in the last seconds of each run, out of all its answers."""
    marked = recent_counts(events.where(ANSWERED), group, totals, seconds)
    return marked.groupBy(group).agg((F.count_if("_recent") / F.lit(float(seconds))).alias("qps"))


def _type_counters() -> list[Column]:
    return [
        F.expr(f"count_if({COUNTERS[name]} and query_type = '{q}') as {q}_{name}")
        for q in D.QUERY_TYPES for name in ("hits", "misses")
    ]


def run_totals(events: DataFrame, group: str, start: float | None = None, as_of: float | None = None) -> DataFrame:
    begin = F.min("ts") if start is None else F.lit(float(start))
    end = F.max("ts") if as_of is None else F.lit(float(as_of))
    return events.groupBy(group).agg(*counters(), *_type_counters(), begin.alias("start"), end.alias("as_of"))


def counted_values(events: DataFrame, group: str, totals: DataFrame) -> DataFrame:
    """All answers and processed messages as counts: (group, event, query_type, value, n, recent).

    `value` is the latency of an answer and the end-to-end time of a processed message.
    """
    relevant = events.where(f"{ANSWERED} or event = 'processed'")
    value = F.when(F.col("event") == "processed", F.col("end_to_end_ms")).otherwise(F.col("latency_ms"))
    return recent_counts(relevant, group, totals).groupBy(group, "event", "query_type", value.alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_recent").alias("recent"))


def latency_lists(counted: DataFrame) -> DataFrame:
    """The counts by list: hit, miss, all (both), e2e and the query types."""
    names = {"hit": "event = 'hit'", "miss": "event = 'miss'", "all": ANSWERED, "e2e": "event = 'processed'"}
    names |= {q: MEMBERS[q] for q in D.QUERY_TYPES}
    kinds = ", ".join(f"case when {condition} then '{kind}' end" for kind, condition in names.items())
    return counted.withColumn("kind", F.expr(f"explode(array_compact(array({kinds})))"))


def run_facts(events: DataFrame, group: str, start: float | None = None, as_of: float | None = None,
              percentile_digits: int = 3, runs: list[str] | None = None) -> DataFrame:
    """Everything the summary and the per-type block are made of, one row per run, out of all its events.

    `events` must be normalised. They are read twice: for the totals, and into a stored table of counted values,
    from which percentiles, means and recent rates follow. With `runs`, only the listed runs are looked at.
    """
    if runs is not None:
        events = events.where(F.col(group).isin(runs))
    spark = events.sparkSession
    totals = store(spark, run_totals(events, group, start, as_of), "totals")
    counted = store(spark, counted_values(events, group, totals), "counted")
    listed = exact_percentiles(latency_lists(counted), [group, "kind"], "value", digits=percentile_digits, weight="n")
    kinds = ["hit", "miss", "all", "e2e", *D.QUERY_TYPES]
    percentiles = listed.groupBy(group).agg(*[
        F.max(F.when(F.col("kind") == kind, F.col(p))).alias(f"{kind}_{p}") for kind in kinds for p in P50_95_99])

    def total(column: str, condition: str) -> str:
        return f"sum(case when {condition} then {column} end)"

    plain = counted.groupBy(group).agg(
        *[F.expr(f"{total('value * n', MEMBERS[k])} / {total('n', MEMBERS[k])} as mean_{k}_ms") for k in ("hit", "miss")],
        F.expr(f"coalesce({total('recent', ANSWERED)}, 0) / {RECENT_SECONDS}D as _recent"),
        F.expr(f"coalesce({total('recent', MEMBERS['processed'])}, 0) / {RECENT_SECONDS}D as _recent_processed"))
    facts = same_group(same_group(totals, percentiles, [group], "left"), plain, [group], "left")
    return facts.fillna(0.0, ["mean_hit_ms", "mean_miss_ms", "_recent", "_recent_processed"])


def run_summary(facts: DataFrame, group: str, *also: str | Column) -> DataFrame:
    """All KPIs of each run as one flat row."""
    hits, misses, total = F.col("hits"), F.col("misses"), F.col("hits") + F.col("misses")
    mean_hit, mean_miss = F.col("mean_hit_ms"), F.col("mean_miss_ms")
    percentiles = [f"{k}_{p}" for k in ("hit", "miss", "all", "e2e") for p in ("p50", "p95", "p99")]
    return facts.select(
        group, F.round(F.col("as_of") - F.col("start"), 2).alias("elapsed_sec"),
        "hits", "misses", "errors", total.alias("total_requests"), *hit_rates(hits, misses),
        F.round(throughput(total, F.col("start"), F.col("as_of")), 2).alias("throughput_qps_total"),
        F.round("_recent", 2).alias("throughput_qps_recent_10s"),
        *percentiles,
        F.round(mean_hit, 3).alias("mean_t_cache_ms"), F.round(mean_miss, 3).alias("mean_t_db_ms"),
        time_saved(hits, total, mean_hit, mean_miss).alias("cache_efficiency"),
        "processed", "recovered", "retried", "dead_lettered",
        F.round(throughput(F.col("processed"), F.col("start"), F.col("as_of")), 2).alias("throughput_processed_qps_total"),
        F.round("_recent_processed", 2).alias("throughput_processed_qps_recent_10s"),
        *finish_rates(), F.col("as_of").alias("snapshot_ts"), *also,
    )


def type_block(q: str) -> str:
    """The facts of a run about one query type, as an SQL struct; zeros and nulls for an unused type."""
    h, m = f"{q}_hits", f"{q}_misses"
    return (
        f"named_struct('hits', {h}, 'misses', {m}, 'total', {h} + {m},"
        f" 'hit_rate', case when {h} + {m} <> 0 then round({h} / ({h} + {m}), 4) end,"
        f" 'p50_ms', {q}_p50, 'p95_ms', {q}_p95, 'p99_ms', {q}_p99)"
    )


def by_query_type(facts: DataFrame, group: str) -> DataFrame:
    """Hits, misses, hit rate and percentiles of each of the five types, one row per type."""
    rows = ", ".join(f"named_struct('query_type', '{q}', 'block', {type_block(q)})" for q in D.QUERY_TYPES)
    return facts.select(group, F.expr(f"inline(array({rows}))")).select(group, "query_type", "block.*")


def window_kpis(records: DataFrame, time: str = "event_time", length: str = "1 minute", slide: str = "30 seconds") -> DataFrame:
    """Sliding-window KPIs. The same function serves a table and a stream."""
    return (
        records.groupBy(F.window(time, length, slide).alias("window"))
        .agg(
            F.count(F.lit(1)).alias("events_in_window"),
            F.percentile_approx("latency_ms", 0.5).alias("p50_ms"),
            F.percentile_approx("latency_ms", 0.95).alias("p95_ms"),
            C.share(F.col("cache") == "HIT").alias("hit_rate"),
            C.share(F.col("retry_count") > 0).alias("retried_share"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                "events_in_window", "p50_ms", "p95_ms", "hit_rate", "retried_share")
    )


def newest_hit_rate(events: DataFrame, group: str, n: int = 200, buffer: int = 1000) -> DataFrame:
    """Hit rate of the newest n answers of each group, out of a buffer of recent results."""
    newest = newest_of_many(events.select(group, "ts", "event_id", "cache"), [group], "ts", "event_id", min(n, buffer))
    return newest.groupBy(group).agg(
        F.count(F.lit(1)).alias("window_size"),
        F.round(C.ratio(F.count_if(F.col("cache") == "HIT"), F.count(F.lit(1))), 4).alias("hit_rate_window"))


def counter_rate(polls: DataFrame, source: str, seconds: str, counter: str, out: str) -> DataFrame:
    """Change per minute of a cumulative counter since the poll before; null without a time step."""
    with_previous = prefix.previous(
        polls, [source], [seconds],
        {"_counter": F.col(counter), "_seconds": F.col(seconds)})
    step = F.col(seconds) - F.col("_seconds")
    return with_previous.withColumn(
        out, F.when(step > 0, F.round((F.col(counter) - F.col("_counter")) * 60.0 / step, 2))
    ).drop("_counter", "_seconds")


def running_counters(events: DataFrame, since: float | None = None) -> DataFrame:
    """Counters since the last reset, by kind of event."""
    kept = events if since is None else events.where(F.col("ts") >= since)
    return kept.groupBy("event").agg(F.count(F.lit(1)).alias("n"))
