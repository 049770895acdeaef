"""Topic records, keyed upserts and labelled snapshots."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonetally import schemas
from zonetally.functions import columns as C


def topic_records(df: DataFrame, topic: Column | str, key: Column | None = None, fields: list[str] | None = None) -> DataFrame:
    """(key, value, topic) with the row as JSON. Rows without a key may go to any partition."""
    topic = F.lit(topic) if isinstance(topic, str) else topic
    key = F.lit(None) if key is None else key
    payload = F.to_json(F.struct(*[F.col(f) for f in (fields or df.columns)]))
    return df.select(key.cast("string").alias("key"), payload.alias("value"), topic.alias("topic"))


def write_topics(records: DataFrame, servers: str) -> None:
    records.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def write_topic_files(records: DataFrame, path: str, mode: str = "append") -> None:
    """One folder per topic, where no broker is at hand."""
    records.write.mode(mode).partitionBy("topic").json(path)


def kpi_documents(kpis: DataFrame) -> DataFrame:
    """Windowed KPIs checked against their declared schema, with the published names and their document id."""
    checked = schemas.require_schema(kpis, schemas.WINDOW_KPI)
    return checked.withColumn("doc_id", C.window_doc_id("window_start", "window_end")).withColumnsRenamed(schemas.KPI_NAMES)


def version_of(run: int, batch_id: int) -> int:
    """Number of a version: that of a later run, or of a later batch of one run, is larger. `run` is the time of its start in ms."""
    return (int(run) << 22) + int(batch_id)


def this_run() -> int:
    return time.time_ns() // 1_000_000


def write_version(df: DataFrame, batch_id: int, path: str, run: int = 0) -> None:
    """Rows of one micro-batch as a version of their keys.

    A batch replayed in the same run overwrites its own folder; a run that starts
    later, also one whose batches count from 0 again, writes newer versions. A
    failed write fails the batch; readers take the newest version of each key.
    """
    df.write.mode("overwrite").parquet(f"{path}/version={version_of(run, batch_id)}")


def read_latest(spark: SparkSession, path: str, key: str, schema: T.StructType) -> DataFrame:
    """Newest version of each key. Keys and version numbers find it; the rows are then picked, not sorted."""
    return _newest(_versions(spark, path, schema), key).select(*schema.names)


def _versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("version", T.LongType())])).parquet(path)


def _newest(rows: DataFrame, key: str) -> DataFrame:
    newest = rows.groupBy(F.col(key).alias("_key")).agg(F.max("version").alias("_newest"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("version") == F.col("_newest"))
    return rows.join(newest, same).drop("_key", "_newest")


def compact(spark: SparkSession, path: str, key: str, schema: T.StructType, target: str, run: int | None = None) -> None:
    """Writes the newest versions as the first version of a new table, for a later switch of readers and writers.

    Versions written to it afterwards by runs that start later replace these.
    """
    write_version(read_latest(spark, path, key, schema), 0, target, this_run() if run is None else run)


def current_base(spark: SparkSession, path: str) -> int:
    """Version whose rows hold all that was written before it; 0 before the first merge."""
    try:
        merged = spark.read.schema("base bigint").parquet(f"{path}/merged")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return merged.agg(F.max("base")).first()[0] or 0


def write_merging(df: DataFrame, batch_id: int, path: str, key: str, run: int = 0, every: int = 50) -> None:
    """`write_version` into a table that every so many batches becomes one version again.

    Versions lie in the folder of the base that they follow. A merge writes the newest rows of all keys, with those of its own batch, as
    the next base, and only then names it; until then readers see the old base, and a merge that fails is done again
    with the batch. A base that is named is never written again. Readers open the newest base and less than `every` versions
    of each run since, whatever has been written before. Replaced bases stay for readers that have opened them; the owner of the
    folder clears them.
    """
    spark, version = df.sparkSession, version_of(run, batch_id)
    base = current_base(spark, path)
    if base >= version:
        return  # replayed after its merge, or older than it
    if (int(batch_id) + 1) % every:
        df.write.mode("overwrite").parquet(f"{path}/base={base}/version={version}")
        return
    batch = df.withColumn("version", F.lit(version))
    try:
        earlier = _versions(spark, f"{path}/base={base}", df.schema).where(F.col("version") < version)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        earlier = batch.limit(0)
    _newest(earlier.unionByName(batch), key).select(*df.columns).write.mode("overwrite").parquet(f"{path}/base={version}/version={version}")
    spark.range(1).select(F.lit(version).alias("base")).write.mode("overwrite").parquet(f"{path}/merged/at={version}")


def read_merged(spark: SparkSession, path: str, key: str, schema: T.StructType) -> DataFrame:
    """Newest rows of a table that `write_merging` writes."""
    return read_latest(spark, f"{path}/base={current_base(spark, path)}", key, schema)


def topic_sink(servers: str | None = None, path: str | None = None):
    """Writer of (key, value, topic) batches: to Kafka, or to a folder per topic, in which a replayed batch replaces itself."""
    def write(records: DataFrame, batch_id: int) -> None:
        if servers is not None:
            write_topics(records, servers)
        else:
            numbered = records.withColumn("batch", F.lit(int(batch_id)))
            numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("topic", "batch").json(path)

    return write


def save_snapshots(documents: DataFrame, path: str) -> None:
    """One JSON folder per label. A later save of a label replaces it and leaves the others.

    `documents` has one row per label; `newest_per_label` makes it so.
    """
    named = documents.withColumn("label_dir", C.safe_label(F.col("label")))
    (
        named.repartition("label_dir").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("label_dir").json(path)
    )
