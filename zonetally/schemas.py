"""Schemas of the tables and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TEXT, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
DOUBLE, BOOL, TIME = T.DoubleType(), T.BooleanType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


BUILDINGS = _struct(zone_id=TEXT, confidence=DOUBLE, area_in_meters=DOUBLE)

REQUEST_PARAMS = _struct(zone_id=TEXT, zone_a=TEXT, zone_b=TEXT, confidence_min=DOUBLE, bins=INT)
REQUEST_MESSAGE = _struct(uuid=TEXT, query_type=TEXT, params=REQUEST_PARAMS, retry_count=INT, created_at=DOUBLE)

EVENT = _struct(
    event=TEXT, query_type=TEXT, key=TEXT, latency_ms=DOUBLE, lookup_ms=DOUBLE, compute_ms=DOUBLE, ttl=INT,
    error=TEXT, ts=DOUBLE, end_to_end_ms=DOUBLE, from_retry=BOOL, retry_count=INT, cache=TEXT)

METRIC_RECORD = _struct(ts=DOUBLE, query_type=TEXT, cache=TEXT, latency_ms=DOUBLE, retry_count=INT, status=TEXT)

WINDOW_KPI = _struct(
    window_start=TIME, window_end=TIME, events_in_window=LONG, p50_ms=DOUBLE, p95_ms=DOUBLE,
    hit_rate=DOUBLE, retried_share=DOUBLE)

# As the table of windows is published, with its document id.
KPI_NAMES = {"events_in_window": "throughput_per_min", "retried_share": "retry_rate"}
KPI_DOCUMENT = T.StructType([
    *[T.StructField(KPI_NAMES.get(f.name, f.name), f.dataType) for f in WINDOW_KPI.fields], T.StructField("doc_id", TEXT)])

PERCENTILES = _struct(p50=DOUBLE, p95=DOUBLE, p99=DOUBLE)
BY_QUERY = _struct(
    hits=LONG, misses=LONG, total=LONG, hit_rate=DOUBLE, p50_ms=DOUBLE, p95_ms=DOUBLE, p99_ms=DOUBLE)
ASYNC_KPIS = _struct(
    processed_total=LONG, recovered_total=LONG, retried_total=LONG, dlq_total=LONG,
    throughput_processed_qps_total=DOUBLE, throughput_processed_qps_recent_10s=DOUBLE,
    latency_e2e_ms=PERCENTILES, retry_rate=DOUBLE, recovery_rate=DOUBLE, dlq_rate=DOUBLE)
QUEUE_HEALTH = _struct(
    backlog_by_topic=T.MapType(TEXT, LONG), backlog_total=LONG, peak_backlog=LONG,
    recovery_time_sec=DOUBLE, draining=BOOL)
SNAPSHOT_SUMMARY = _struct(
    elapsed_sec=DOUBLE, totals=_struct(hits=LONG, misses=LONG, errors=LONG, total_requests=LONG),
    hit_rate=DOUBLE, miss_rate=DOUBLE, throughput_qps_total=DOUBLE, throughput_qps_recent_10s=DOUBLE,
    latency_ms_hit=PERCENTILES, latency_ms_miss=PERCENTILES, latency_ms_all=PERCENTILES,
    mean_t_cache_ms=DOUBLE, mean_t_db_ms=DOUBLE, cache_efficiency=DOUBLE,
    eviction=_struct(total_evicted=LONG, rate_per_min=DOUBLE), async_kpis=ASYNC_KPIS, queue_health=QUEUE_HEALTH,
    by_query=T.MapType(TEXT, BY_QUERY), extra=T.MapType(TEXT, TEXT), snapshot_ts=DOUBLE)
# A file holds the document at the root, or under `summary`.
SNAPSHOT_FILE = T.StructType([
    T.StructField("label", TEXT),
    T.StructField("summary", T.StructType([T.StructField("label", TEXT), *SNAPSHOT_SUMMARY.fields])),
    *SNAPSHOT_SUMMARY.fields,
])


def require_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of the contract in its order; fails on a missing column or another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f.name for f in schema.fields if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"columns not as declared: {', '.join(wrong)}")
    return df.select(*schema.names)
