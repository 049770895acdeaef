import json

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonetally import schemas
from zonetally.functions import columns as C
from zonetally.operators import kpis as K
from zonetally.operators import retries as RT
from zonetally.operators import sketches as SK
from zonetally.plans.stream_queries import ATTEMPT, DOCUMENT, REQUEST
from zonetally.sources.readers import file_stream, parse_json
from zonetally.sources.writers import compact, kpi_documents, read_latest, read_merged, write_merging, write_version
from zonetally.streaming import jobs as J
from zonetally.streaming import stateful as ST


class Topic:
    """A folder that grows by one file per call, in arrival order."""

    def __init__(self, path):
        self.path, self.n = path / "in", 0
        self.path.mkdir()

    def add(self, records):
        lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
        target = self.path / f"{self.n:05d}.txt"
        target.write_text("\n".join(lines) + "\n")
        self.n += 1


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path)


def record(ts, latency=1.0, cache="HIT", retries=0):
    return {"ts": ts, "query_type": "Q1", "cache": cache, "latency_ms": latency, "retry_count": retries, "status": "processed"}


def run(stream, write, tmp_path, mode="update"):
    q = J.start(stream, write, str(tmp_path / "state"), J.UNTIL_EMPTY, mode)
    q.awaitTermination()
    return q


def kpis(spark, tmp_path):
    df = read_latest(spark, str(tmp_path / "out"), "doc_id", DOCUMENT)
    return {r["doc_id"]: tuple(r)[:-1] for r in df.collect()}


def batch_kpis(spark, records):
    df = spark.createDataFrame([tuple(r.values()) for r in records], schemas.METRIC_RECORD).withColumn("event_time", C.event_time())
    out = kpi_documents(K.window_kpis(df))
    return {r["doc_id"]: tuple(r)[:-1] for r in out.collect()}


def test_stream_equals_batch_and_drops_late_rows(spark, topic, tmp_path):
    rng = np.random.default_rng(4)
    records = [record(1000.0 + i * 2.5, float(np.round(rng.random() * 50, 2)), str(rng.choice(["HIT", "MISS"])), int(rng.integers(3))) for i in range(300)]
    stream = J.kpi_stream(file_stream(spark, str(topic.path), files_per_batch=1))
    write = J.upsert_kpis(str(tmp_path / "out"))
    for part in range(0, 300, 60):
        topic.add(records[part:part + 60] + ["garbage", "{}", '{"ts": "x"}'])
        run(stream, write, tmp_path)
    assert kpis(spark, tmp_path) == batch_kpis(spark, records)
    topic.add([record(1000.0, 999.0)] * 5)
    run(stream, write, tmp_path)
    assert kpis(spark, tmp_path) == batch_kpis(spark, records)
    late_but_in_time = record(records[-1]["ts"] - 30.0, 77.0)
    topic.add([late_but_in_time])
    run(stream, write, tmp_path)
    assert kpis(spark, tmp_path) == batch_kpis(spark, [*records, late_but_in_time])


def test_each_row_counts_in_two_windows(spark, topic, tmp_path):
    topic.add([record(100.0)])
    run(J.kpi_stream(file_stream(spark, str(topic.path))), J.upsert_kpis(str(tmp_path / "out")), tmp_path)
    assert sorted(kpis(spark, tmp_path)) == ["1970-01-01T00-01-00_1970-01-01T00-02-00", "1970-01-01T00-01-30_1970-01-01T00-02-30"]


def test_replayed_batch_changes_nothing(spark, topic, tmp_path):
    topic.add([record(float(t)) for t in range(0, 300, 7)])
    write = J.upsert_kpis(str(tmp_path / "out"))

    def failing_after_write(batch, batch_id):
        write(batch, batch_id)
        raise RuntimeError("lost before the commit")

    stream = J.kpi_stream(file_stream(spark, str(topic.path)))
    with pytest.raises(StreamingQueryException):
        run(stream, failing_after_write, tmp_path)
    once = kpis(spark, tmp_path)
    run(stream, write, tmp_path)
    assert kpis(spark, tmp_path) == once == batch_kpis(spark, [record(float(t)) for t in range(0, 300, 7)])


def test_compacted_table_reads_the_same(spark, topic, tmp_path):
    stream = J.kpi_stream(file_stream(spark, str(topic.path)), "1 day")
    write = J.upsert_kpis(str(tmp_path / "out"))
    for _ in range(3):
        topic.add([record(float(t)) for t in range(0, 100, 9)])
        run(stream, write, tmp_path)
    before = kpis(spark, tmp_path)
    compact(spark, str(tmp_path / "out"), "doc_id", DOCUMENT, str(tmp_path / "compacted"))
    rows = spark.read.parquet(str(tmp_path / "compacted"))
    assert rows.count() == len(before)
    assert {r["doc_id"]: r["throughput_per_min"] for r in rows.collect()} == {k: v[2] for k, v in before.items()}


def test_history_over_several_batches(spark, topic, tmp_path):
    attempts = [("a", 1, False), ("b", 1, True), ("c", 1, False), ("a", 2, False), ("c", 2, True), ("a", 3, False), ("d", 1, False)]
    rows = [{"uuid": u, "ts": 50000.0 + 10 * n, "attempt": n, "retry_count": n - 1, "ok": ok} for u, n, ok in attempts]
    stream = J.message_history_stream(
        parse_json(file_stream(spark, str(topic.path)), ATTEMPT).withColumn("created_at", F.lit(50000.0)))
    for part in (rows[:2], rows[2:5], rows[5:]):
        topic.add(part)
        run(stream, J.upsert(str(tmp_path / "out")), tmp_path)
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("uuid", T.StringType()), ("state", T.StringType()), ("attempts", T.IntegerType()), ("first_ts", T.DoubleType()), ("last_ts", T.DoubleType()))])
    got = {tuple(r) for r in read_latest(spark, str(tmp_path / "out"), "uuid", schema).collect()}
    want = {tuple(r) for r in RT.message_history(spark.createDataFrame([tuple(r.values()) for r in rows], ATTEMPT)).collect()}
    assert got == want and {(r[0], r[1]) for r in got} == {("a", "dead_letter"), ("b", "ok"), ("c", "recovered"), ("d", "pending")}


def test_reuse_out_of_order(spark, topic, tmp_path):
    """Batches overlap in time; each row comes within the delay, but for late ones that are counted and left out."""
    rng = np.random.default_rng(8)
    times = np.sort(np.round(rng.random(120) * 300, 3))
    rows = [{"request_id": i, "cache_key": "hot" if i % 3 else f"k{i % 7}", "us": int(round(t * 1e6)), "ttl_us": 20_000_000} for i, t in enumerate(times)]
    came = sorted(rows, key=lambda r: r["us"] + rng.integers(0, 100_000_000))
    closing = {"request_id": None, "cache_key": None, "us": 10_000_000_000, "ttl_us": None}
    no_answer = [{"request_id": 900, "cache_key": None, "us": 5_000_000, "ttl_us": 1}, {"request_id": 901, "cache_key": "hot", "us": 6_000_000, "ttl_us": None}]
    stream, late = ST.hit_or_miss_stream(parse_json(file_stream(spark, str(topic.path)), REQUEST), "110 seconds"), 0
    for batch in ([*came[:40], *no_answer], came[40:80], came[80:], [closing], rows[:9]):
        topic.add(batch)
        query = J.start(stream, J.upsert(str(tmp_path / "out")), str(tmp_path / "state"), J.UNTIL_EMPTY, "append")
        query.awaitTermination()
        late += ST.late_rows(query)
    got = {r["request_id"]: r["cache"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    until: dict[str, int] = {}
    for r in rows:
        miss = r["us"] >= until.get(r["cache_key"], -1)
        if miss:
            until[r["cache_key"]] = r["us"] + r["ttl_us"]
        assert got[r["request_id"]] == ("MISS" if miss else "HIT")
    assert len(got) == len(rows) and late == 9


def test_routing_writes_each_target(spark, topic, tmp_path):
    rows = [{"uuid": f"m{i}", "ts": 1.0, "attempt": i % 4 + 1, "retry_count": i % 4, "ok": i % 5 == 0} for i in range(40)]
    topic.add(rows)
    run(parse_json(file_stream(spark, str(topic.path)), ATTEMPT), J.route_attempts(str(tmp_path / "out")), tmp_path, "append")
    got = {r["uuid"]: r["target"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    for i in range(40):
        assert got[f"m{i}"] == ("metrics" if i % 5 == 0 else "dead_letter" if i % 4 + 1 >= 3 else "retry")


def test_progress_reports(spark):
    report = {"timestamp": "2024-01-01T00:00:02.000Z", "sources": [{
        "startOffset": None, "endOffset": {"main": {"0": 5, "1": 7}, "retry": {"0": 1}}, "latestOffset": {"main": {"0": 9, "1": 7}, "retry": {"0": 4}}}]}
    df = spark.createDataFrame([(json.dumps(report),)], "value string")
    got = {(r["topic"], r["part"], r["high_offset"], r["committed_offset"]) for r in J.progress_offsets(df).collect()}
    assert got == {("main", 0, 9, 5), ("main", 1, 7, 7), ("retry", 0, 4, 1)}


def test_new_checkpoint_wins_over_old_batches(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])
    rows = lambda n, *keys: spark.createDataFrame([(k, n) for k in keys], schema)
    out = str(tmp_path / "t")
    write_version(rows(1, "a", "b", None), 5, out, run=100)
    write_version(rows(2, "a", None), 0, out, run=101)
    write_version(rows(2, "a", None), 0, out, run=101)
    assert {tuple(r) for r in read_latest(spark, out, "k", schema).collect()} == {("a", 2), ("b", 1), (None, 2)}
    compact(spark, out, "k", schema, str(tmp_path / "c"))
    assert {tuple(r) for r in read_latest(spark, str(tmp_path / "c"), "k", schema).collect()} == {("a", 2), ("b", 1), (None, 2)}


def test_kpi_program(spark, topic, tmp_path):
    from zonetally.streaming import main

    records = [record(float(t)) for t in range(0, 300, 7)]
    topic.add(records)
    main.main(["--files", str(topic.path), "--out", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "state"), "--until-empty",
               "--compact-to", str(tmp_path / "c")])
    assert kpis(spark, tmp_path) == batch_kpis(spark, records)
    assert spark.read.parquet(str(tmp_path / "c")).count() == len(kpis(spark, tmp_path))


def test_panes_of_a_stream_give_windows_of_any_length(spark, topic, tmp_path):
    rng = np.random.default_rng(8)
    rows = [record(1000.0 + i * 2.5, float(np.round(rng.random() * 50, 2)), str(rng.choice(["HIT", "MISS"])), int(rng.integers(3))) for i in range(240)]
    panes = J.pane_stream(file_stream(spark, str(topic.path), files_per_batch=1))
    for part in range(0, 240, 80):
        topic.add(rows[part:part + 80] + ["garbage"])
        run(panes, J.upsert_merging(str(tmp_path / "panes"), "pane_start", every=2), tmp_path)
    stored = read_merged(spark, str(tmp_path / "panes"), "pane_start", panes.schema)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schemas.METRIC_RECORD).withColumn("event_time", C.event_time())
    for length, slide in ((60, 30), (300, 150)):
        want = {r[0]: tuple(r) for r in K.window_kpis(df, length=f"{length} seconds", slide=f"{slide} seconds").collect()}
        got = {r[0]: tuple(r) for r in SK.windows_of_panes(stored, 30, length, slide).collect()}
        assert got.keys() == want.keys() and all(got[k][1:] == (want[k][1], *(pytest.approx(x) for x in want[k][2:])) for k in want)


def test_payloads_are_sorted_and_counted_by_batch(spark, topic, tmp_path):
    out = str(tmp_path / "sorted")
    batches = [
        [record(1000.0), record(1200.0), "garbage", "{}", '{"ts": "x"}'],
        [record(1079.0), record(1080.0), record(1500.0), ""],   # the limit is 1200 - 120
        [record(1379.0), record(1380.0)],
    ]
    for batch in batches:
        topic.add(batch)
        run(file_stream(spark, str(topic.path), files_per_batch=1), J.sort_payloads(out), tmp_path, "append")
    reports = [tuple(r)[2:] for r in J.batch_reports(spark, out).orderBy("batch_id").collect()]
    assert reports == [(5, 1, 2, 0, 2), (4, 1, 0, 1, 2), (2, 0, 0, 1, 1)]
    late = J.sorted_payloads(spark, out, "late")
    assert sorted((r["batch_id"], json.loads(r["value"])["ts"]) for r in late.collect()) == [(1, 1079.0), (2, 1379.0)]
    assert sorted(r["value"] for r in J.sorted_payloads(spark, out, "unreadable").collect()) == ["", "garbage"]


def test_replayed_batch_is_sorted_as_before(spark, tmp_path):
    out, lines = str(tmp_path / "sorted"), "key string, value string, topic string"
    write = J.sort_payloads(out)
    first, second = ([(None, json.dumps(record(t)), None) for t in times] for times in ((1000.0, 2000.0), (500.0, 9000.0)))
    for batch_id, rows in ((0, first), (1, second), (0, first), (1, second), (2, [])):
        write(spark.createDataFrame(rows, lines), batch_id)
    reports = [(r["batch_id"], r["payloads"], r["late"], r["kept"]) for r in J.batch_reports(spark, out).orderBy("batch_id").collect()]
    assert reports == [(0, 2, 0, 2), (1, 2, 1, 1), (2, 0, 0, 0)]
    assert J.sorted_payloads(spark, out, "kept").count() == 3


def test_progress_reports_carry_the_counts(spark, topic, tmp_path):
    topic.add([record(1000.0), "garbage", "more garbage"])
    stream = J.kpi_stream(J.with_payload_counts(file_stream(spark, str(topic.path), files_per_batch=1)))
    found = []
    for rows in ([], [record(1010.0)]):
        if rows:
            topic.add(rows)
        q = run(stream, J.upsert_kpis(str(tmp_path / "out")), tmp_path)
        found += [tuple(r)[1:] for r in J.progress_counts(J.recent_progress(q)).collect()]
    assert found == [(3, 2), (1, 0)]


def test_many_batches_are_merged(spark, tmp_path):
    """60 batches of two runs, replays and a merge that failed before it was named: right rows, few files."""
    out, schema = str(tmp_path / "table"), T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    want, every = {}, 8
    for number in range(60):
        run_no, batch = (1, number) if number < 27 else (2, number - 27)
        rows = [(f"k{number % 5}", number), (f"n{number}", number), (None, number)]
        for _replay in range(2 if number % 7 in (0, 1) else 1):
            write_merging(spark.createDataFrame(rows, schema), batch, out, "k", run_no, every)
        want |= dict(rows)
        if number == 40:
            # a later batch's base that was written in part and never named
            spark.createDataFrame([("k0", -1)], schema).write.parquet(f"{out}/base=99999999/version=99999999")
    got = read_merged(spark, out, "k", schema)
    assert {r["k"]: r["v"] for r in got.collect()} == want and got.count() == len(want)
    folders = {f.rsplit("/", 1)[0] for f in got.inputFiles()}
    assert len(folders) <= every and len({f.rsplit("/", 1)[0] for f in folders}) == 1


def test_merge_in_the_first_batch(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    write_merging(spark.createDataFrame([("a", 1)], schema), 0, str(tmp_path / "t"), "k", 1, every=1)
    write_merging(spark.createDataFrame([("a", 2), ("b", 3)], schema), 1, str(tmp_path / "t"), "k", 1, every=1)
    assert {tuple(r) for r in read_merged(spark, str(tmp_path / "t"), "k", schema).collect()} == {("a", 2), ("b", 3)}
