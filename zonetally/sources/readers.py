"""Scans of tables, topics and snapshot files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonetally import schemas


def read_buildings(spark: SparkSession, path: str) -> DataFrame:
    """Buildings parquet; a missing path is an error. Only declared columns are read."""
    return spark.read.schema(schemas.BUILDINGS).parquet(path)


def topic_stream(spark: SparkSession, servers: str, topics: list[str], starting: str = "latest", **options: str) -> DataFrame:
    """Key and value of one or more topics. Progress is kept in the query's checkpoint.

    Needs the Kafka connector on the classpath; `file_stream` has the same columns.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
    )
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"), "topic")


def file_stream(spark: SparkSession, path: str, topic: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Text lines that arrive as files, with the columns of `topic_stream`."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(F.lit(None).cast("string").alias("key"), "value", F.lit(topic).cast("string").alias("topic"))


def together(*inputs: DataFrame) -> DataFrame:
    """Several inputs with the same columns as one, duplicates kept."""
    first, *rest = inputs
    for other in rest:
        first = first.unionByName(other)
    return first


def parse_json(payloads: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Payload fields as columns. A field of another type becomes null, the row stays."""
    return payloads.select(F.from_json(F.col(value).cast("string"), schema).alias("d")).select("d.*")


def is_json(value: str = "value") -> Column:
    return F.try_parse_json(F.col(value).cast("string")).isNotNull()


def split_json(payloads: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Readable payloads, and the rejects for a side table."""
    return payloads.where(is_json(value)), payloads.where(~is_json(value))


def read_events(payloads: DataFrame, value: str = "value") -> DataFrame:
    """Telemetry events from JSON; only `event` is required."""
    return parse_json(payloads, schemas.EVENT, value).where(F.col("event").isNotNull())


def read_snapshots(spark: SparkSession, *paths: str) -> DataFrame:
    """Snapshot files: the document under `summary` where there is one, else the root.

    The label falls back to the name of the file or of its label folder. Paths
    without a match are skipped.
    """
    frames = []
    for path in paths:
        reader = spark.read.schema(schemas.SNAPSHOT_FILE).option("multiLine", True).option("recursiveFileLookup", True)
        try:
            frames.append(reader.json(path))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    if not frames:
        frames.append(spark.createDataFrame([], schemas.SNAPSHOT_FILE))
    raw = together(*frames)
    whole = F.struct(*[F.col(f.name) for f in schemas.SNAPSHOT_SUMMARY.fields])
    inner = F.struct(*[F.col(f"summary.{f.name}").alias(f.name) for f in schemas.SNAPSHOT_SUMMARY.fields])
    name = F.regexp_extract(F.input_file_name(), r"snap_([^/]+)\.json$", 1)
    label = F.coalesce("label", "summary.label", F.nullif(name, F.lit("")))
    return (
        raw.select(label.alias("label"), F.when(F.col("summary").isNotNull(), inner).otherwise(whole).alias("d"))
        .select("label", "d.*")
    )
