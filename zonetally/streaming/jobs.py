"""Streaming queries: parse, aggregate, write, with the batch operators inside."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonetally import schemas
from zonetally.functions import columns as C
from zonetally.operators import kpis as K
from zonetally.operators import retries as R
from zonetally.operators import sketches as SK
from zonetally.sources.readers import is_json, parse_json
from zonetally.sources.writers import kpi_documents, this_run, write_merging, write_version

TRIGGER = {"processingTime": "10 seconds"}
UNTIL_EMPTY = {"availableNow": True}


def timed_records(payloads: DataFrame) -> DataFrame:
    """Metric records with their event time. Unreadable payloads have none and fall out of windows."""
    return parse_json(payloads, schemas.METRIC_RECORD).withColumn("event_time", C.event_time())


def kpi_stream(payloads: DataFrame, delay: str = "2 minutes", length: str = "1 minute", slide: str = "30 seconds") -> DataFrame:
    """Sliding-window KPIs of a stream; rows later than the watermark are dropped."""
    return K.window_kpis(timed_records(payloads).withWatermark("event_time", delay), "event_time", length, slide)


def pane_stream(payloads: DataFrame, delay: str = "2 minutes", seconds: int = 30) -> DataFrame:
    """Panes of a stream, to be stored by their start; `windows_of_panes` makes windows of any length of the stored table."""
    return SK.window_panes(timed_records(payloads).withWatermark("event_time", delay), "event_time", seconds)


def start(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
          trigger: dict = TRIGGER, mode: str = "update") -> StreamingQuery:
    """Runs `write` on every micro-batch. An error in it stops the query, so no batch is lost."""
    return (
        stream.writeStream.foreachBatch(write).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def upsert_kpis(path: str, run: int | None = None) -> Callable[[DataFrame, int], None]:
    """Keyed upsert of KPI documents: a replayed batch replaces its own rows only. A new writer is a new run."""
    run = this_run() if run is None else run
    return lambda batch, batch_id: write_version(kpi_documents(batch), batch_id, path, run)


def upsert(path: str, run: int | None = None) -> Callable[[DataFrame, int], None]:
    run = this_run() if run is None else run
    return lambda batch, batch_id: write_version(batch, batch_id, path, run)


def upsert_merging(path: str, key: str, run: int | None = None, every: int = 50) -> Callable[[DataFrame, int], None]:
    """As `upsert`, for streams that run long: every so many batches the table becomes one version again."""
    run = this_run() if run is None else run
    return lambda batch, batch_id: write_merging(batch, batch_id, path, key, run, every)


def route_attempts(path: str) -> Callable[[DataFrame, int], None]:
    """Writes each attempt to the folder of its target, all targets of a batch in one job."""
    def write(batch: DataFrame, batch_id: int) -> None:
        R.route(batch).write.mode("overwrite").partitionBy("target").parquet(f"{path}/batch_id={int(batch_id)}")

    return write


def payload_counts() -> list[Column]:
    """What is counted of the payloads of a batch: all, and those that are no JSON."""
    return [F.count(F.lit(1)).alias("payloads"), F.count_if(~is_json()).alias("unreadable")]


def with_payload_counts(payloads: DataFrame) -> DataFrame:
    """The same stream, whose progress reports carry the counts of each batch; they come from the job that runs anyway."""
    return payloads.observe("payload_counts", *payload_counts())


SORTED_COUNTS = ("payloads", "unreadable", "untimed", "late", "kept")
REPORT = "batch_id bigint, newest timestamp, " + ", ".join(f"{c} bigint" for c in SORTED_COUNTS)


def batch_reports(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch that `sort_payloads` has written: its counts and the newest time that it held."""
    try:
        found = spark.read.schema(REPORT).parquet(f"{path}/reports")
        return found.select("batch_id", "newest", *SORTED_COUNTS)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REPORT)


def sort_payloads(path: str, delay: str = "2 minutes") -> Callable[[DataFrame, int], None]:
    """Files every payload of a batch under what it is, and reports how many there were of each kind.

    `unreadable` is no JSON, `untimed` has no time, `late` is older than the newest time of all earlier batches less
    the delay, the rest is `kept`. So rows that windowed KPIs leave out are neither lost nor uncounted. The counts are observed
    in the one job that writes the rows. A replayed batch replaces its rows and its report; earlier reports, which decide
    what is late, stay as they are.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = batch_reports(spark, path).where(F.col("batch_id") < int(batch_id))
        limit = earlier.agg((F.max("newest") - F.expr(f"interval {delay}")).cast("string")).first()[0]
        time = F.timestamp_seconds(F.get_json_object("value", "$.ts").try_cast("double"))
        timed = batch.withColumn("event_time", F.when(is_json(), time))
        kind = (
            F.when(~is_json(), "unreadable").when(F.col("event_time").isNull(), "untimed")
            .when(F.col("event_time") < F.lit(limit).cast("timestamp"), "late").otherwise("kept")
        )
        seen = Observation()
        counts = [F.count_if(F.col("kind") == k).alias(k) for k in SORTED_COUNTS[1:]]
        sorted_rows = timed.withColumn("kind", kind).observe(
            seen, F.count(F.lit(1)).alias("payloads"), *counts, F.max("event_time").cast("string").alias("newest"))
        sorted_rows.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/rows/batch_id={int(batch_id)}")
        found = seen.get
        row = spark.range(1).select(
            F.lit(found["newest"]).cast("timestamp").alias("newest"), *[F.lit(found[c]).cast("bigint").alias(c) for c in SORTED_COUNTS])
        row.write.mode("overwrite").parquet(f"{path}/reports/batch_id={int(batch_id)}")

    return write


def sorted_payloads(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The filed rows of one kind, with the batch that brought them; only their folders are opened."""
    rows = spark.read.schema("key string, value string, topic string, event_time timestamp, batch_id bigint, kind string").parquet(f"{path}/rows")
    return rows.where(F.col("kind") == kind).drop("kind")


def handle_messages(path: str, publish: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Files every attempt under its target and sends failed messages on: to the retry topic with the raised count, at
    the end to the dead letters. `publish` is a topic sink."""
    file_away = route_attempts(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        file_away(batch, batch_id)
        publish(R.messages_to_repeat(batch), batch_id)

    return write


def kpi_job(payloads: DataFrame, path: str, checkpoint: str, trigger: dict = TRIGGER, **windows: str) -> StreamingQuery:
    """Topic to windowed KPIs to keyed documents, as one running query."""
    return start(kpi_stream(payloads, **windows), upsert_kpis(path), checkpoint, trigger)


def message_history_stream(attempts: DataFrame, keep: str = "1 day") -> DataFrame:
    """State of each message after every micro-batch that touched it (update mode).

    The creation time, the same on all attempts of a message, bounds the state: a
    message is forgotten once the watermark is `keep` past the day it was made.
    """
    created = attempts.withColumn("created_time", F.col("created_at").cast("timestamp")).withWatermark("created_time", keep)
    return R.message_history(created, also_by=[F.window("created_time", "1 day")])


def progress_offsets(progress: DataFrame, value: str = "value") -> DataFrame:
    """Offsets per poll, topic and partition from the progress reports of a topic query."""
    offsets = "map<string, map<string, bigint>>"
    report = F.from_json(value, f"timestamp string, sources array<struct<endOffset: {offsets}, latestOffset: {offsets}>>")
    per_topic = (
        progress.select(report.alias("r")).select("r.timestamp", F.explode("r.sources").alias("s"))
        .select("timestamp", "s.endOffset", F.explode("s.latestOffset").alias("topic", "high"))
    )
    return per_topic.select(
        F.to_timestamp("timestamp").alias("poll_ts"), "topic", F.col("endOffset")[F.col("topic")].alias("_done"),
        F.explode("high").alias("part", "high_offset"),
    ).select("poll_ts", "topic", F.col("part").cast("bigint").alias("part"), "high_offset",
             F.col("_done")[F.col("part")].alias("committed_offset"))


def progress_counts(progress: DataFrame, value: str = "value") -> DataFrame:
    """The counts of `with_payload_counts` per batch, from the progress reports of a query."""
    fields = "batchId bigint, observedMetrics struct<payload_counts: struct<payloads: bigint, unreadable: bigint>>"
    report = F.from_json(value, fields)
    return progress.select(report.alias("r")).select(F.col("r.batchId").alias("batch_id"), "r.observedMetrics.payload_counts.*").where("payloads > 0")


def recent_progress(query: StreamingQuery) -> DataFrame:
    """The last reports a running query keeps (a short fixed number) as a table."""
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame([(p.json if hasattr(p, "json") else str(p),) for p in query.recentProgress], "value string")
