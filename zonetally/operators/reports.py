"""Snapshot documents and the tables of the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonetally.functions import domains as D
from zonetally.functions.columns import path_or
from zonetally.operators.kpis import run_summary, type_block
from zonetally.operators.percentiles import same_group

PERCENTILE_NAMES = ("p50", "p95", "p99")


def _percentiles(prefix: str) -> Column:
    return F.expr("struct({})".format(", ".join(f"{prefix}_{p} as {p}" for p in PERCENTILE_NAMES)))


def _by_query() -> Column:
    return F.expr("map({})".format(", ".join(f"'{q}', {type_block(q)}" for q in D.QUERY_TYPES)))


def newest_eviction(rates: DataFrame, group: str, seconds: str) -> DataFrame:
    """(group, total_evicted, rate_per_min) at each run's last poll; `rates` as `counter_rate` gives them, a row per poll."""
    last = rates.groupBy(F.col(group).alias("_group")).agg(F.max(seconds).alias("_last"))
    at_last = rates[group].eqNullSafe(F.col("_group")) & (F.col(seconds) == F.col("_last"))
    return rates.join(last, at_last).select(group, F.col("evicted").cast("bigint").alias("total_evicted"), "rate_per_min")


def documents(facts: DataFrame, queue: DataFrame | None, group: str, extra: dict[str, str] | None = None,
              eviction: DataFrame | None = None, lags: DataFrame | None = None) -> DataFrame:
    """One nested document per run from its facts, its queue health, its evictions and its lag by topic.

    `eviction` has total_evicted and rate_per_min, `lags` a row per topic with its `lag`.
    """
    joined = run_summary(facts, group, _by_query().alias("by_query"))
    health = F.lit(None).cast("struct<backlog_by_topic:map<string,bigint>,backlog_total:bigint,peak_backlog:bigint,recovery_time_sec:double,draining:boolean>")
    by_topic = F.lit(None).cast("map<string,bigint>")
    if lags is not None:
        entries = F.map_from_entries(F.collect_list(F.struct("topic", F.col("lag").cast("bigint"))))  # a handful of topics
        joined = same_group(joined, lags.groupBy(group).agg(entries.alias("_topics")), [group], "left")
        by_topic = F.col("_topics")
    if queue is not None:
        block = F.struct("backlog_total", F.col("peak_backlog").cast("bigint").alias("peak_backlog"), "recovery_time_sec", "draining")
        joined = same_group(joined, queue.select(group, block.alias("_queue")), [group], "left")
        health = F.when(F.col("_queue").isNotNull(), F.struct(by_topic.alias("backlog_by_topic"), "_queue.*"))
    evicted = F.lit(None).cast("struct<total_evicted:bigint,rate_per_min:double>")
    if eviction is not None:
        joined = same_group(joined, eviction.select(group, F.struct("total_evicted", "rate_per_min").alias("_eviction")), [group], "left")
        evicted = F.col("_eviction")
    entries = [F.lit(v) for pair in (extra or {}).items() for v in pair]
    extras = F.create_map(*entries) if entries else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return joined.select(
        F.col(group).alias("label"), "elapsed_sec",
        F.struct("hits", "misses", "errors", "total_requests").alias("totals"),
        "hit_rate", "miss_rate", "throughput_qps_total", "throughput_qps_recent_10s",
        _percentiles("hit").alias("latency_ms_hit"), _percentiles("miss").alias("latency_ms_miss"),
        _percentiles("all").alias("latency_ms_all"),
        "mean_t_cache_ms", "mean_t_db_ms", "cache_efficiency",
        F.struct(
            F.col("processed").alias("processed_total"), F.col("recovered").alias("recovered_total"),
            F.col("retried").alias("retried_total"), F.col("dead_lettered").alias("dlq_total"),
            "throughput_processed_qps_total", "throughput_processed_qps_recent_10s",
            _percentiles("e2e").alias("latency_e2e_ms"), "retry_rate", "recovery_rate", "dlq_rate",
        ).alias("async_kpis"),
        evicted.alias("eviction"), health.alias("queue_health"), "by_query", extras.alias("extra"), "snapshot_ts",
    )


def newest_per_label(docs: DataFrame) -> DataFrame:
    """A later document replaces an earlier one of its label."""
    rest = [c for c in docs.columns if c != "label"]
    # maps cannot be compared, but max_by only orders by the time
    return docs.groupBy("label").agg(F.max_by(F.struct(*rest), "snapshot_ts").alias("d")).select("label", "d.*")


def _constants(spark: SparkSession, name: str, values: list[str]) -> DataFrame:
    """A fixed list as a relation, with its display position."""
    listed = ", ".join(f"({i}, '{v}')" for i, v in enumerate(values))
    return spark.sql(f"select * from values {listed} as t(position, {name})")


def run_grid(spark: SparkSession) -> DataFrame:
    """Every policy, size and distribution with the label of its run."""
    def each(values: list[str]) -> Column:
        return F.explode(F.array(*[F.lit(v) for v in values]))

    grid = (
        _constants(spark, "policy", D.POLICIES).drop("position")
        .withColumn("size", each(D.SIZES)).withColumn("dist", each(D.DISTRIBUTIONS))
    )
    return grid.withColumn("label", F.concat_ws("_", "policy", "size", "dist"))


def _on_grid(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return run_grid(spark).join(docs, "label", "left")


def hit_rate_of(spark: SparkSession, docs: DataFrame, labels: list[str]) -> DataFrame:
    chosen = _constants(spark, "label", labels)
    return chosen.join(docs, "label", "left").select("position", "label", path_or("hit_rate", 0.0).alias("hit_rate"))


def hit_rate_by_distribution(spark: SparkSession, docs: DataFrame, size: str = "50mb") -> DataFrame:
    cells = _on_grid(spark, docs).where(F.col("size") == size)
    return cells.groupBy("policy").pivot("dist", D.DISTRIBUTIONS).agg(F.first(path_or("hit_rate", 0.0)))


def hit_rate_by_size(spark: SparkSession, docs: DataFrame, dist: str = "zipf") -> DataFrame:
    cells = _on_grid(spark, docs).where(F.col("dist") == dist)
    pivoted = cells.groupBy("policy").pivot("size", D.SIZES).agg(F.first(path_or("hit_rate", 0.0)))
    return pivoted.select("policy", *[F.col(s).alias(f"size_{s}") for s in D.SIZES])


def throughput_by_distribution(spark: SparkSession, docs: DataFrame, size: str = "50mb") -> DataFrame:
    cells = _on_grid(spark, docs).where(F.col("size") == size)
    pivoted = cells.groupBy("policy").pivot("dist", D.DISTRIBUTIONS).agg(F.first(path_or("throughput_qps_total", 0.0)))
    return pivoted.withColumn("target", F.lit(D.TARGET_QPS))


def hit_and_miss_latency(spark: SparkSession, docs: DataFrame, size: str = "50mb", dist: str = "zipf") -> DataFrame:
    """Long form, one row per policy and series; 0 is shown as 0.01 for a logarithmic scale."""
    series = {"p50_hit": "latency_ms_hit.p50", "p95_hit": "latency_ms_hit.p95",
              "p50_miss": "latency_ms_miss.p50", "p95_miss": "latency_ms_miss.p95"}
    cells = _on_grid(spark, docs).where((F.col("size") == size) & (F.col("dist") == dist)).select(
        "policy", *[F.coalesce(F.nullif(F.col(path), F.lit(0.0)), F.lit(0.01)).alias(name) for name, path in series.items()])
    return cells.unpivot("policy", list(series), "series", "latency_ms")


def hit_rate_by_type(spark: SparkSession, docs: DataFrame, labels: list[str]) -> DataFrame:
    """Query types down, chosen runs across; 0 where a run lacks the type."""
    types = _constants(spark, "query_type", D.QUERY_TYPES)
    blocks = (
        docs.where(F.col("label").isin(labels)).select("label", F.explode("by_query").alias("query_type", "block"))
        .groupBy("query_type").pivot("label", labels).agg(F.first("block.hit_rate"))
    )
    return types.join(blocks, "query_type", "left").select(
        "query_type", *[F.coalesce(F.col(f"`{name}`"), F.lit(0.0)).alias(name) for name in labels])


def time_saved_of(spark: SparkSession, docs: DataFrame, labels: list[str]) -> DataFrame:
    chosen = _constants(spark, "label", labels)
    return chosen.join(docs, "label", "left").select(
        "position", "label", path_or("cache_efficiency", 0.0).alias("saved_ms_per_request"))


def _scenarios(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return _constants(spark, "label", D.SCENARIOS).join(docs, "label")


def scenario_throughput(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Processed rate, else the overall rate; a rate of 0 counts as missing."""
    rates = [F.nullif(F.col(c), F.lit(0.0)) for c in ("async_kpis.throughput_processed_qps_total", "throughput_qps_total")]
    return _scenarios(spark, docs).select("position", "label", F.coalesce(*rates, F.lit(0.0)).alias("throughput_qps"))


def scenario_latency(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """End-to-end percentiles in seconds, for scenarios that have them."""
    latency = "async_kpis.latency_e2e_ms"
    return _scenarios(spark, docs).where(F.col(f"{latency}.p50").isNotNull()).select(
        "position", "label", *[(F.col(f"{latency}.{p}") / 1000).alias(f"{p}_sec") for p in PERCENTILE_NAMES])


def consumer_scaling(docs: DataFrame, one: str = "kafka_1c", three: str = "kafka_3c") -> DataFrame:
    """Four measures, the run with one consumer next to the one with three."""
    measures = {
        "throughput_qps": F.col("async_kpis.throughput_processed_qps_total"),
        "e2e_p50_sec": F.col("async_kpis.latency_e2e_ms.p50") / 1000,
        "peak_backlog": F.col("queue_health.peak_backlog").cast("double"),
        "recovery_time_sec": F.col("queue_health.recovery_time_sec"),
    }
    long = docs.where(F.col("label").isin(one, three)).select("label", *[c.alias(k) for k, c in measures.items()]).unpivot(
        "label", list(measures), "measure", "value")
    return long.groupBy("measure").agg(
        F.max(F.when(F.col("label") == one, F.col("value"))).alias("consumers_1"),
        F.max(F.when(F.col("label") == three, F.col("value"))).alias("consumers_3"))


def fault_measures(docs: DataFrame, label: str = "failure") -> DataFrame:
    """Three rates and four counts of the failure scenario, one per row."""
    measures = {
        "retry_rate": "async_kpis.retry_rate", "recovery_rate": "async_kpis.recovery_rate", "dlq_rate": "async_kpis.dlq_rate",
        "retried": "async_kpis.retried_total", "recovered": "async_kpis.recovered_total", "dlq": "async_kpis.dlq_total",
        "peak_backlog": "queue_health.peak_backlog",
    }
    one = docs.where(F.col("label") == label).select("label", *[F.col(p).cast("double").alias(k) for k, p in measures.items()])
    return one.unpivot("label", list(measures), "measure", "value").drop("label")


def scenario_backlog(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Peak backlog and recovery time of the scenarios that had a backlog."""
    return _scenarios(spark, docs).where(F.col("queue_health.peak_backlog") > 0).select(
        "position", "label", F.col("queue_health.peak_backlog").alias("peak_backlog"),
        path_or("queue_health.recovery_time_sec", 0.0).alias("recovery_time_sec"))
