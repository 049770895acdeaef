"""Streaming jobs run to the end of their input, and the sinks they use.

Inputs are files written from the test tables; every query has folders of its own
under the session's checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonetally import schemas
from zonetally.functions import columns as C
from zonetally.operators import backlog as B
from zonetally.operators import kpis as K
from zonetally.operators import sketches as SK
from zonetally.operators.requests import with_key
from zonetally.plans.fixtures import attempts, offset_polls, query_events, requests
from zonetally.plans.kpi_queries import WINDOW_ROWS, WINDOWS, iso_windows, payloads
from zonetally.plans.queue_queries import HISTORY, LAG
from zonetally.plans.registry import query, rounded
from zonetally.plans.request_queries import TTL, _long_ttl
from zonetally.session import scratch_path, store
from zonetally.sources.readers import file_stream, parse_json, together
from zonetally.sources.writers import (
    kpi_documents, read_latest, read_merged, topic_records, topic_sink, write_merging, write_topic_files, write_version,
)
from zonetally.streaming import jobs as J
from zonetally.streaming import stateful as ST

E, RQ, A = ("query_events",), ("requests",), ("attempts",)
READABLE = WINDOWS.replace("where event = 'processed'", "where event = 'processed' and event_id % 97 <> 0")
DOCUMENT = schemas.KPI_DOCUMENT
INNER_NAMES = {published: name for name, published in schemas.KPI_NAMES.items()}
HOUR = {"length": "1 hour", "slide": "30 minutes"}


def _run(stream, write, checkpoint, mode="update"):
    J.start(stream, write, checkpoint, J.UNTIL_EMPTY, mode).awaitTermination()


def _text_stream(spark, lines, name="in", files_per_batch=None):
    path = scratch_path(spark, name)
    lines.select("value").write.text(path)
    return file_stream(spark, path, files_per_batch=files_per_batch)


def _json(df):
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def _latest_kpis(spark, out):
    return iso_windows(read_latest(spark, out, "doc_id", DOCUMENT).drop("doc_id").withColumnsRenamed(INNER_NAMES))


def _kpis_of(spark, stream, delay):
    out = scratch_path(spark, "kpis")
    _run(J.kpi_stream(stream, delay, **HOUR), J.upsert_kpis(out), scratch_path(spark, "state"))
    return _latest_kpis(spark, out)


@query("src02_metrics_stream", """
select ts, upper(coalesce(nullif(query_type, ''), 'UNK')) as query_type, cache, end_to_end_ms as latency_ms, coalesce(retry_count, 0)::int as retry_count,
  'processed' as status from query_events where event = 'processed' and event_id % 97 <> 0""", E)
def _(spark, d):
    out = scratch_path(spark, "records")
    records = parse_json(_text_stream(spark, payloads(spark, d)), schemas.METRIC_RECORD).where(F.col("ts").isNotNull())
    _run(records, J.upsert(out), scratch_path(spark, "state"), "append")
    return spark.read.schema(schemas.METRIC_RECORD).parquet(out).select(*schemas.METRIC_RECORD.names)


def _two_topics(spark, d):
    """Requests as messages on the main topic, tried ones on the retry topic."""
    topic = F.when(F.col("retry_count") > 0, "retry").otherwise("main")
    path = scratch_path(spark, "topics")
    write_topic_files(topic_records(requests(spark, d), topic, F.col("zone_a"), ["request_id", "query_type"]), path)
    lines = [file_stream(spark, f"{path}/topic={t}", t) for t in ("main", "retry")]
    both = together(*lines).select(
        F.get_json_object("value", "$.key").alias("key"), F.get_json_object("value", "$.value").alias("value"), "topic")
    out = scratch_path(spark, "messages")
    _run(both, J.upsert(out), scratch_path(spark, "state"), "append")
    return spark.read.schema("key string, value string, topic string").parquet(out)


@query("src03_two_topics", "select case when retry_count > 0 then 'retry' else 'main' end as topic, zone_a as key, request_id from requests", RQ)
def _(spark, d):
    return _two_topics(spark, d).select("topic", "key", F.get_json_object("value", "$.request_id").cast("bigint").alias("request_id"))


@query("set02_topics_together", "select case when retry_count > 0 then 'retry' else 'main' end as topic, query_type, count(*) as n from requests group by 1, 2", RQ)
def _(spark, d):
    kind = F.get_json_object("value", "$.query_type").alias("query_type")
    return _two_topics(spark, d).groupBy("topic", kind).agg(F.count(F.lit(1)).alias("n"))


@query("snk02_keyed_upsert", WINDOWS + WINDOW_ROWS, E)
def _(spark, d):
    """A first run with a high batch number, then a later run that counts from 0 again and replays a batch."""
    out = scratch_path(spark, "upsert")
    full = K.window_kpis(K.metric_records(query_events(spark, d)).withColumn("event_time", C.event_time()), **HOUR)
    write_version(kpi_documents(full.withColumn("hit_rate", F.lit(0.0))), 5, out, run=1)
    for _attempt in range(2):
        write_version(kpi_documents(full), 0, out, run=2)
    return _latest_kpis(spark, out)


@query("snk02_merged_versions", WINDOWS + WINDOW_ROWS, E)
def _(spark, d):
    """Two runs of batches, each with a sixth of the windows; the first run's are all replaced. Every fourth batch merges."""
    out = scratch_path(spark, "merged")
    full = store(spark, kpi_documents(K.window_kpis(K.metric_records(query_events(spark, d)).withColumn("event_time", C.event_time()), **HOUR)), "kpis")
    for run, documents in ((1, full.withColumn("hit_rate", F.lit(0.0))), (2, full)):
        for batch in range(6):
            part = documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(6)) == batch)
            write_merging(part, batch, out, "doc_id", run, every=4)
    return iso_windows(read_merged(spark, out, "doc_id", DOCUMENT).drop("doc_id").withColumnsRenamed(INNER_NAMES))


@query("snk03_kpi_contract", WINDOWS + "select strftime(w, '%Y-%m-%dT%H-%M-%S') || '_' || strftime(w + interval 1 hour, '%Y-%m-%dT%H-%M-%S') as doc_id from win group by w", E)
def _(spark, d):
    full = K.window_kpis(K.metric_records(query_events(spark, d)).withColumn("event_time", C.event_time()), **HOUR)
    return schemas.require_schema(kpi_documents(full), schemas.KPI_DOCUMENT).select("doc_id")


@query("str01_watermarked_kpis", READABLE + WINDOW_ROWS, E)
def _(spark, d):
    return _kpis_of(spark, _text_stream(spark, payloads(spark, d)), "2 minutes")


@query("str02_sliding_windows", READABLE + "select strftime(w, '%Y-%m-%dT%H:%M:%S') as window_start, count(*) as n from win group by w", E)
def _(spark, d):
    out = scratch_path(spark, "windows")
    timed = J.timed_records(_text_stream(spark, payloads(spark, d))).withWatermark("event_time", "2 minutes")
    counts = timed.groupBy(F.window("event_time", "1 hour", "30 minutes")).agg(F.count(F.lit(1)).alias("n")).select(
        C.iso("window.start").alias("window_start"), "n")
    _run(counts, J.upsert(out), scratch_path(spark, "state"))
    return read_latest(spark, out, "window_start", T.StructType([
        T.StructField("window_start", T.StringType()), T.StructField("n", T.LongType())]))


@query("str02_windows_from_stored_panes", READABLE + WINDOW_ROWS, E)
def _(spark, d):
    """A stream stores panes, in two batches; the windows are put together from them on reading."""
    out = scratch_path(spark, "panes")
    stream = file_stream(spark, _in_two_files(spark, payloads(spark, d)), files_per_batch=1)
    panes = J.pane_stream(stream, "40 days", 1800)
    _run(panes, J.upsert(out), scratch_path(spark, "state"))
    return iso_windows(SK.windows_of_panes(read_latest(spark, out, "pane_start", panes.schema), 1800, 3600, 1800))


def _in_two_files(spark, lines):
    """The same rows as two files, each over the whole time."""
    path = scratch_path(spark, "in")
    for part in (0, 1):
        lines.where(F.col("event_id") % 2 == part).select("value").coalesce(1).write.mode("append").text(path)
    return path


@query("str03_update_mode", READABLE + WINDOW_ROWS, E)
def _(spark, d):
    """Two micro-batches touch the same windows; the watermark is wide enough for both."""
    path = _in_two_files(spark, payloads(spark, d))
    return _kpis_of(spark, file_stream(spark, path, files_per_batch=1), "40 days")


@query("str04_late_rows_dropped", READABLE + WINDOW_ROWS, E)
def _(spark, d):
    """After all rows, a file with the rows of the first 20 days again: all too late to count."""
    path, out, state = (scratch_path(spark, n) for n in ("in", "kpis", "state"))
    lines = payloads(spark, d)
    lines.select("value").write.text(path)
    stream = J.kpi_stream(file_stream(spark, path), "2 minutes", **HOUR)
    _run(stream, J.upsert_kpis(out), state)
    lines.where(F.get_json_object("value", "$.ts").cast("double") < 1705795200.0).select("value").write.mode("append").text(path)
    _run(stream, J.upsert_kpis(out), state)
    return _latest_kpis(spark, out)


@query("str05_micro_batch_upsert", READABLE + "select strftime(w, '%Y-%m-%dT%H-%M-%S') || '_' || strftime(w + interval 1 hour, '%Y-%m-%dT%H-%M-%S') as doc_id, count(*) as throughput_per_min from win group by w", E)
def _(spark, d):
    out = scratch_path(spark, "kpis")
    stream = J.kpi_stream(file_stream(spark, _in_two_files(spark, payloads(spark, d)), files_per_batch=1), "40 days", **HOUR)
    _run(stream, J.upsert_kpis(out), scratch_path(spark, "state"))
    return read_latest(spark, out, "doc_id", DOCUMENT).select("doc_id", "throughput_per_min")


@query("flt03_unreadable_by_batch", """
select event_id % 2 as batch_id, count(*) as payloads, count(*) filter (where event_id % 97 = 0) as unreadable
from query_events where event = 'processed' group by 1""", E)
def _(spark, d):
    """Counts that the progress reports of the KPI job carry."""
    lines = J.with_payload_counts(file_stream(spark, _in_two_files(spark, payloads(spark, d)), files_per_batch=1))
    job = J.kpi_job(lines, scratch_path(spark, "kpis"), scratch_path(spark, "state"), J.UNTIL_EMPTY, delay="40 days", **HOUR)
    job.awaitTermination()
    return J.progress_counts(J.recent_progress(job))


SORTED = """
with p as (select event_id, event_id % 2 as batch_id, case when event_id % 97 <> 0 then make_timestamp(cast(round(ts * 1e6) as bigint)) end as t
  from query_events where event = 'processed'),
k as (select *, case when t is null then 'unreadable'
  when batch_id = 1 and t < (select max(t) from p where batch_id = 0) - interval 10 days then 'late' else 'kept' end as kind from p)
"""


def _sorted(spark, d):
    out = scratch_path(spark, "sorted")
    stream = file_stream(spark, _in_two_files(spark, payloads(spark, d)), files_per_batch=1)
    _run(stream, J.sort_payloads(out, "10 days"), scratch_path(spark, "state"), "append")
    return out


@query("str04_late_and_unreadable_counted", SORTED + """
select batch_id, count(*) as payloads, count(*) filter (where kind = 'unreadable') as unreadable, 0::bigint as untimed,
  count(*) filter (where kind = 'late') as late, count(*) filter (where kind = 'kept') as kept from k group by 1""", E)
def _(spark, d):
    return J.batch_reports(spark, _sorted(spark, d)).drop("newest")


@query("str04_late_rows_kept_apart", SORTED + "select batch_id, strftime(t, '%Y-%m-%dT%H:%M:%S') as at, count(*) as n from k where kind = 'late' group by 1, 2", E)
def _(spark, d):
    late = J.sorted_payloads(spark, _sorted(spark, d), "late")
    return late.groupBy("batch_id", C.iso("event_time").alias("at")).agg(F.count(F.lit(1)).alias("n"))


ATTEMPT = T.StructType([
    T.StructField("uuid", T.StringType()), T.StructField("ts", T.DoubleType()), T.StructField("attempt", T.LongType()),
    T.StructField("retry_count", T.LongType()), T.StructField("ok", T.BooleanType())])
ROUTED = "select uuid, attempt, case when ok then 'metrics' when retry_count + 1 >= 3 then 'dead_letter' else 'retry' end as target from attempts"


def _attempt_stream(spark, d):
    return parse_json(_text_stream(spark, _json(attempts(spark, d).select(*ATTEMPT.names))), ATTEMPT)


@query("str06_routed_attempts", ROUTED, A)
def _(spark, d):
    out = scratch_path(spark, "routed")
    _run(_attempt_stream(spark, d), J.route_attempts(out), scratch_path(spark, "state"), "append")
    return spark.read.schema("uuid string, attempt bigint, target string").parquet(out).select("uuid", "attempt", "target")


@query("str07_message_history", HISTORY + "select uuid, state, attempts, round(first_ts, 6) as first_ts, round(last_ts, 6) as last_ts from hist", A)
def _(spark, d):
    out = scratch_path(spark, "history")
    # the test messages live for a day and carry no creation time; any attempt's time names that day
    stream = J.message_history_stream(_attempt_stream(spark, d).withColumn("created_at", F.col("ts")))
    _run(stream, J.upsert(out), scratch_path(spark, "state"))
    final = read_latest(spark, out, "uuid", T.StructType([
        T.StructField("uuid", T.StringType()), T.StructField("state", T.StringType()), T.StructField("attempts", T.IntegerType()),
        T.StructField("first_ts", T.DoubleType()), T.StructField("last_ts", T.DoubleType())]))
    return rounded(final, 6, "first_ts", "last_ts")


@query("str08_running_counters", "select event, count(*) as n from query_events where event is not null group by 1", E)
def _(spark, d):
    out = scratch_path(spark, "counters")
    events = parse_json(_text_stream(spark, _json(query_events(spark, d).select("event", "ts"))), schemas.EVENT)
    _run(K.running_counters(events), J.upsert(out), scratch_path(spark, "state"))
    return read_latest(spark, out, "event", T.StructType([T.StructField("event", T.StringType()), T.StructField("n", T.LongType())]))


@query("str09_replayed_batch", ROUTED, A)
def _(spark, d):
    """A batch that is handled twice, as after a failure between write and commit."""
    out = scratch_path(spark, "routed")
    write = J.route_attempts(out)

    def twice(batch, batch_id):
        write(batch, batch_id)
        write(batch, batch_id)

    _run(_attempt_stream(spark, d), twice, scratch_path(spark, "state"), "append")
    return spark.read.schema("uuid string, attempt bigint, target string").parquet(out).select("uuid", "attempt", "target")


@query("str10_progress_lag", f"""
select strftime(poll_ts, '%Y-%m-%dT%H:%M:%S') as poll, topic, sum({LAG})::bigint as lag from offset_polls group by 1, 2""", ("offset_polls",))
def _(spark, d):
    """Progress reports with the offsets of the polls, one report per poll."""
    part = F.col("part").cast("string")
    per_topic = offset_polls(spark, d).groupBy("poll_ts", "topic").agg(
        F.map_from_entries(F.collect_list(F.struct(part, "high_offset"))).alias("high"),
        F.map_from_entries(F.collect_list(F.struct(part, "committed_offset"))).alias("done"))
    reports = per_topic.groupBy("poll_ts").agg(
        F.array(F.struct(
            F.map_from_entries(F.collect_list(F.struct("topic", "done"))).alias("endOffset"),
            F.map_from_entries(F.collect_list(F.struct("topic", "high"))).alias("latestOffset"),
        )).alias("sources")
    ).select(F.to_json(F.struct(F.date_format("poll_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"), "sources")).alias("value"))
    return B.topic_lag(J.progress_offsets(reports)).select(C.iso("poll_ts").alias("poll"), "topic", "lag")


REQUEST = T.StructType([
    T.StructField("request_id", T.LongType()), T.StructField("cache_key", T.StringType()),
    T.StructField("us", T.LongType()), T.StructField("ttl_us", T.LongType())])


def _reuse_requests(spark, d):
    return with_key(requests(spark, d)).where(F.col("query_type") != "Q6").select(
        "request_id", "cache_key", F.round(F.col("created_at") * 1e6).cast("bigint").alias("us"),
        (_long_ttl().cast("bigint") * 1000000).alias("ttl_us"))


def _closing(keyed):
    """A row without a request, a year after the last one: it has the requests before it judged."""
    year = 366 * 86400 * 1000000
    return keyed.agg(F.lit(None).cast("bigint").alias("request_id"), F.lit(None).cast("string").alias("cache_key"),
                     (F.max("us") + year).alias("us"), F.lit(None).cast("bigint").alias("ttl_us"))


def _judged(spark, path, delay, files_per_batch=None):
    """The answers, and how many rows were late."""
    stream = parse_json(file_stream(spark, path, files_per_batch=files_per_batch), REQUEST)
    out = scratch_path(spark, "answers")
    run = J.start(ST.hit_or_miss_stream(stream, delay), J.upsert(out), scratch_path(spark, "state"), J.UNTIL_EMPTY, "append")
    run.awaitTermination()
    return spark.read.schema(ST.REUSE_OUT).parquet(out).select("request_id", "cache_key", "cache"), ST.late_rows(run)


@query("str11_hit_or_miss_stream", TTL + "select request_id, cache_key, cache from flag", RQ)
def _(spark, d):
    keyed, path = _reuse_requests(spark, d), scratch_path(spark, "in")
    for rows in (keyed, _closing(keyed)):
        _json(rows).write.mode("append").text(path)
    return _judged(spark, path, "2 minutes")[0]


def _out_of_order(spark, d, again=None):
    """Requests in three files, each row up to ten days later than it was made; then the closing row. Rows that come
    `again` are late: the batch after the closing row's judges the others, and the one behind that finds them passed."""
    keyed, path = _reuse_requests(spark, d), scratch_path(spark, "in")
    days = F.floor((F.col("us") / 86400000000 + F.pmod(F.xxhash64("request_id"), F.lit(10))) / 10)
    first = keyed.agg(F.min(days)).first()[0] or 0
    part = F.least(days - first, F.lit(2))
    for rows in (*(keyed.where(part == n) for n in range(3)), _closing(keyed), *([_closing(keyed), again(keyed)] if again else [])):
        _json(rows).coalesce(1).write.mode("append").text(path)
    return path


@query("str13_requests_out_of_order", TTL + "select request_id, cache_key, cache from flag", RQ)
def _(spark, d):
    return _judged(spark, _out_of_order(spark, d), "40 days", 1)[0]


@query("str14_late_requests_counted", "select count(*) as late, (select count(*) from requests where query_type <> 'Q6') as judged from requests where query_type <> 'Q6' and request_id % 7 = 0", RQ)
def _(spark, d):
    answers, late = _judged(spark, _out_of_order(spark, d, lambda keyed: keyed.where("request_id % 7 = 0")), "40 days", 1)
    return answers.agg(F.lit(late).cast("bigint").alias("late"), F.count(F.lit(1)).alias("judged"))


MESSAGE = T.StructType([T.StructField("uuid", T.StringType()), T.StructField("retry_count", T.LongType())])


@query("str12_failed_messages_come_back", HISTORY + "select uuid, state, attempts from hist where state <> 'pending'", A)
def _(spark, d):
    """Messages go out on the main topic; failed ones return from the retry topic with a raised count, till they succeed or
    end as dead letters. Whether a try succeeds is looked up in the attempts; messages without a further one stay pending."""
    tries = attempts(spark, d).select("uuid", (F.col("attempt") - 1).alias("retry_count"), "ok")
    topics, out, state = (scratch_path(spark, n) for n in ("topics", "routed", "state"))
    first = tries.where("retry_count = 0").select("uuid", "retry_count")
    topic_sink(path=topics)(topic_records(first, "main", F.col("uuid")), 0)
    for n, topic in enumerate(("main", "retry", "retry")):
        lines = file_stream(spark, f"{topics}/topic={topic}", topic)
        messages = parse_json(lines.select(F.get_json_object("value", "$.value").alias("value")), MESSAGE)
        tried = messages.where(F.col("retry_count") == n).join(tries, ["uuid", "retry_count"]).withColumns(
            {"key": F.col("uuid"), "attempt": F.col("retry_count") + 1})
        # sink batches of the rounds have numbers of their own
        sink = topic_sink(path=topics)
        handle = J.handle_messages(f"{out}/round={n}", lambda records, batch_id, n=n: sink(records, 1000 * (n + 1) + batch_id))
        _run(tried, handle, f"{state}-{n}", "append")
    done = spark.read.schema("uuid string, attempt bigint, target string, round int, batch_id bigint").parquet(out)
    last = done.where("target in ('metrics', 'dead_letter')")
    state_of = F.when(F.col("target") == "dead_letter", "dead_letter").when(F.col("attempt") == 1, "ok").otherwise("recovered")
    return last.select("uuid", state_of.alias("state"), F.col("attempt").cast("int").alias("attempts"))
