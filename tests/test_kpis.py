import numpy as np
import pytest
from pyspark.sql import functions as F

from zonetally import schemas
from zonetally.functions import columns as C
from zonetally.operators import kpis as K
from zonetally.operators import reports as R
from zonetally.operators import retries as RT

EVENTS = ("run string, event_id bigint, event string, query_type string, latency_ms double, ts double, end_to_end_ms double,"
          " from_retry boolean, retry_count int, cache string")


def event_rows(seed, n, run="a"):
    rng = np.random.default_rng(seed)
    kinds = ["hit", "miss", "error", "processed", "retry", "recovered", "dlq", "other"]
    rows = []
    for i in range(n):
        kind = str(rng.choice(kinds, p=[.4, .2, .05, .2, .05, .03, .05, .02]))
        rows.append((run, i, kind, [None, "", "q1", "Q2", "q3", "Q5", "Q7"][rng.integers(7)],
                     None if rng.random() < .1 else float(np.round(rng.random() * 100, 2)), 1000.0 + float(np.round(i * .37, 2)),
                     None if rng.random() < .2 else float(np.round(rng.random() * 1000, 2)), [None, True, False][rng.integers(3)],
                     int(rng.integers(0, 3)), "HIT"))
    return rows


def test_facts_of_whole_runs(spark):
    runs = {"a": event_rows(1, 400, "a"), None: event_rows(2, 150, None)}
    df = K.normalise(spark.createDataFrame([r for rows in runs.values() for r in rows], EVENTS), 5.0)
    facts = K.run_facts(df, "run", percentile_digits=9)
    got = {r["run"]: r for r in K.run_summary(facts, "run").collect()}
    types = {(r["run"], r["query_type"]): r for r in K.by_query_type(facts, "run").collect()}
    for run, rows in runs.items():
        r = got[run]
        event, latency = np.array([x[2] for x in rows]), np.array([x[4] or 0.0 for x in rows])
        qt, ts = np.array([(x[3] or "UNK").upper() for x in rows]), np.array([x[5] for x in rows])
        e2e = np.array([np.nan if x[6] is None else x[6] for x in rows])
        hit, miss, done = event == "hit", event == "miss", event == "processed"
        answered, recent = hit | miss, ts >= ts.max() - 10
        back = np.array([bool(x[7]) for x in rows])
        assert [r[k] for k in ("hits", "misses", "errors", "processed", "retried", "recovered", "dead_lettered")] == [
            hit.sum(), miss.sum(), (event == "error").sum(), done.sum(), (event == "retry").sum(),
            (event == "recovered").sum() + (done & back).sum(), (event == "dlq").sum()]
        for name, pool in {"hit": latency[hit], "miss": latency[miss], "all": latency[answered], "e2e": e2e[done & ~np.isnan(e2e)]}.items():
            assert [r[f"{name}_p{p}"] for p in (50, 95, 99)] == pytest.approx(list(np.percentile(pool, (50, 95, 99))), abs=1e-6)
        assert r["throughput_qps_recent_10s"] == round((answered & recent).sum() / 10, 2)
        assert r["throughput_processed_qps_recent_10s"] == round((done & recent).sum() / 10, 2)
        assert r["hit_rate"] == pytest.approx(hit.sum() / answered.sum(), abs=1e-4)
        saved = hit.sum() * (latency[miss].mean() - latency[hit].mean()) / answered.sum()
        assert r["cache_efficiency"] == pytest.approx(saved, abs=2e-3)
        for q in ("Q1", "Q2", "Q3", "Q4", "Q5"):
            t, pool = types[(run, q)], latency[answered & (qt == q)]
            assert (t["hits"], t["misses"]) == ((hit & (qt == q)).sum(), (miss & (qt == q)).sum())
            assert t["p95_ms"] == (pytest.approx(np.percentile(pool, 95), abs=1e-6) if len(pool) else None)
    assert ("a", "UNK") not in types and types[("a", "Q4")]["hit_rate"] is None


def test_no_answer_is_left_out(spark):
    """More answers than any fixed window holds, most of them in the last ten seconds."""
    df = spark.range(45_000).selectExpr(
        "'a' as run", "id as event_id", "'hit' as event", "'Q1' as query_type", "double(id % 1000) as latency_ms",
        "1000D + id / 5000 as ts", "null as end_to_end_ms", "false as from_retry", "0 as retry_count", "'HIT' as cache")
    r = K.run_summary(K.run_facts(df.withColumn("end_to_end_ms", F.lit(None).cast("double")), "run"), "run").first()
    assert r["throughput_qps_recent_10s"] == 4500.0 and r["hit_p50"] == 499.5 and r["mean_t_cache_ms"] == 499.5


def test_run_without_answers_has_nulls(spark):
    df = K.normalise(spark.createDataFrame([("x", 1, "error", None, None, 10.0, None, None, None, None)], EVENTS), 5.0)
    r = K.run_summary(K.run_facts(df, "run"), "run").first()
    assert r["hit_rate"] is None and r["miss_rate"] is None and r["all_p50"] is None and r["cache_efficiency"] is None
    assert (r["retry_rate"], r["dlq_rate"], r["recovery_rate"]) == (None, None, None)
    assert (r["mean_t_cache_ms"], r["throughput_qps_total"], r["throughput_qps_recent_10s"], r["errors"]) == (0.0, 0.0, 0.0, 1)


def test_retry_rate_may_exceed_one(spark):
    df = spark.createDataFrame([(1, 3, 0, 0)], "processed int, retried int, dead_lettered int, recovered int").select(*K.finish_rates())
    assert tuple(df.first()) == (3.0, 0.0, None)


def test_normalise_defaults(spark):
    rows = [("r", 1, "hit", None, None, None, None, None, None, None), ("r", 2, "hit", "", 1.0, 0.0, None, None, None, None),
            ("r", 3, "hit", "q4", 2.0, 7.0, None, None, None, None)]
    out = K.normalise(spark.createDataFrame(rows, EVENTS), 99.0).orderBy("event_id").select("query_type", "latency_ms", "ts").collect()
    assert [tuple(r) for r in out] == [("UNK", 0.0, 99.0), ("UNK", 1.0, 99.0), ("Q4", 2.0, 7.0)]


def test_metric_records_only_processed(spark):
    rows = [("r", 1, "processed", None, 5.0, 1.0, 8.0, None, None, "HIT"), ("r", 2, "hit", "q1", 5.0, 1.0, 8.0, None, 1, "HIT")]
    out = [tuple(r) for r in K.metric_records(spark.createDataFrame(rows, EVENTS)).collect()]
    assert out == [(1.0, "UNK", "HIT", 8.0, 0, "processed")]


def test_null_counts_as_false_in_shares(spark):
    df = spark.createDataFrame([("HIT",), (None,), ("MISS",), ("HIT",)], "cache string")
    assert df.agg(C.share(F.col("cache") == "HIT").alias("s")).first()["s"] == 0.5


def test_message_history_states(spark):
    rows = [("ok", 1, True), ("ok", 2, False), ("rec", 1, False), ("rec", 2, True), ("dead", 1, False), ("dead", 2, False),
            ("dead", 3, False), ("dead", 4, True), ("wait", 1, False)]
    df = spark.createDataFrame([(u, float(a), a, ok) for u, a, ok in rows], "uuid string, ts double, attempt bigint, ok boolean")
    got = {r["uuid"]: (r["state"], r["attempts"], r["last_ts"]) for r in RT.message_history(df).collect()}
    assert got == {"ok": ("ok", 1, 1.0), "rec": ("recovered", 2, 2.0), "dead": ("dead_letter", 3, 3.0), "wait": ("pending", 1, 1.0)}


def test_last_failure_counts_as_retry_too(spark):
    df = spark.createDataFrame([(0, 0, True), (0, 1, True), (0, 0, False), (0, 2, False)], "worker int, retry_count int, ok boolean")
    r = RT.worker_counters(df, "worker").first()
    assert tuple(r) == (0, 2, 2, 1, 1, 0)
    targets = {(x["retry_count"], x["ok"]): x["target"] for x in RT.route(df).collect()}
    assert targets == {(0, True): "metrics", (1, True): "metrics", (0, False): "retry", (2, False): "dead_letter"}


def test_run_grid_is_complete(spark):
    grid = R.run_grid(spark).collect()
    assert len(grid) == 18 and len({r["label"] for r in grid}) == 18 and grid[0]["label"].count("_") == 2


def test_newest_document_wins(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 9.0), ("b", 3, 1.0)], "label string, hits int, snapshot_ts double")
    assert {(r["label"], r["hits"]) for r in R.newest_per_label(df).collect()} == {("a", 2), ("b", 3)}


def test_contract_check(spark):
    good = K.window_kpis(spark.createDataFrame([(1.0, "Q1", "HIT", 2.0, 0, "processed")], schemas.METRIC_RECORD).withColumn(
        "event_time", C.event_time()))
    assert schemas.require_schema(good, schemas.WINDOW_KPI).count() == 2
    with pytest.raises(ValueError, match="hit_rate"):
        schemas.require_schema(good.withColumn("hit_rate", F.lit("x")), schemas.WINDOW_KPI)
