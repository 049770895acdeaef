"""Ordered operators against plain Python, with chunks of many widths."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from zonetally.operators import backlog as B
from zonetally.operators import kpis as K
from zonetally.operators import prefix
from zonetally.operators import ttl
from zonetally.operators.newest import newest_of_few, newest_of_many, newest_overall
from zonetally.operators.percentiles import exact_percentiles


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(3)
    n = 400
    return pd.DataFrame({
        "g": np.where(rng.random(n) < 0.4, "hot", rng.choice(list("abcd"), n)),
        "t": np.round(rng.random(n) * 1000, 3), "id": np.arange(n), "v": rng.integers(-5, 9, n)})


@pytest.fixture(params=[1, 3, 40])
def ranges(spark, request):
    """Many ranges, few rows each; AQE would put them together."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def running(df):
    out = prefix.running_sum(df, ["g"], ["t", "id"], F.col("v"), "total")
    out = prefix.running_max(out, ["g"], ["t", "id"], F.col("v"), "top")
    return prefix.previous(out, ["g"], ["t", "id"], {"before": F.col("v")})


def wanted(series):
    s = series.sort_values(["t", "id"])
    by = s.groupby("g", dropna=False)["v"]
    return pd.DataFrame({"id": s["id"], "total": by.cumsum(), "top": by.cummax(), "before": by.shift(1)}).sort_values("id").reset_index(drop=True).astype(float)


def test_running_operators(spark, series, ranges):
    got = running(spark.createDataFrame(series)).select("id", "total", "top", "before").toPandas()
    pd.testing.assert_frame_equal(got.sort_values("id").reset_index(drop=True).astype(float), wanted(series))


def test_null_groups_and_a_spike(spark, series, ranges):
    """Half of the rows have no group, and all rows of a group fall into one second."""
    odd = series.assign(g=np.where(series["id"] % 2 == 0, None, series["g"]), t=np.where(series["g"] == "hot", 5.0, series["t"]))
    df = spark.createDataFrame(list(odd.itertuples(index=False, name=None)), "g string, t double, id long, v long")
    got = running(df).select("id", "total", "top", "before").toPandas()
    pd.testing.assert_frame_equal(got.sort_values("id").reset_index(drop=True).astype(float), wanted(odd))
    counts = {r["id"]: r["n"] for r in prefix.rolling_count(df, ["g"], "t", 10.0, "n").collect()}
    us = (odd["t"] * 1e6).round().astype("int64")
    for i, row in odd.iterrows():
        same = odd["g"].isna() if row["g"] is None else odd["g"] == row["g"]
        assert counts[row["id"]] == (same & (us <= us[i]) & (us >= us[i] - 10_000_000)).sum()


@pytest.mark.parametrize("ranges", [16], indirect=True)
def test_a_spike_is_cut_evenly(spark, ranges):
    """Ninety percent of the rows in one second of one group: no chunk has over twice the mean."""
    df = spark.range(100_000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 70)).alias("g"),
                                     F.when(F.col("id") % 10 > 0, 7.0).otherwise(F.col("id").cast("double")).alias("t"), "id")
    sizes = [r["count"] for r in prefix._chunked(df, ["g"], ["t", "id"], None).groupBy(prefix.CHUNK).count().collect()]
    assert len(sizes) > 8 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    out = prefix.running_sum(df, ["g"], ["t", "id"], F.lit(1), "n")
    assert out.where("g = 'hot'").agg(F.max("n"), F.count_distinct("n")).first()[:] == (90_000, 90_000)


def test_running_sum_without_groups(spark, series, ranges):
    out = prefix.running_sum(spark.createDataFrame(series), [], ["id"], F.col("v"), "total")
    got = out.toPandas().sort_values("id")
    assert got["total"].tolist() == series["v"].cumsum().tolist()


def test_rolling_count(spark, series, ranges):
    out = prefix.rolling_count(spark.createDataFrame(series), ["g"], "t", 10.0, "n").toPandas().set_index("id")["n"]
    assert len(out) == len(series)
    us = (series["t"] * 1e6).round().astype("int64")
    for i, row in series.iterrows():
        same = (series["g"] == row["g"]) & (us <= us[i]) & (us >= us[i] - 10_000_000)
        assert out[row["id"]] == same.sum()


@pytest.mark.parametrize("n", [1, 5, 1000])
def test_newest(spark, series, n):
    df = spark.createDataFrame(series.assign(t=series["t"].round(0)))
    want = series.assign(t=series["t"].round(0)).sort_values(["t", "id"], ascending=False)
    per_group = set(want.groupby("g").head(n)["id"])
    assert {r["id"] for r in newest_of_few(df, "g", ["hot", "a", "b", "c", "d"], "t", "id", n, 50.0).collect()} == per_group
    assert {r["id"] for r in newest_of_many(df, ["g"], "t", "id", n).collect()} == per_group
    assert {r["id"] for r in newest_overall(df, "t", "id", n).collect()} == set(want.head(n)["id"])


def test_newest_of_a_spike(spark, monkeypatch):
    """A million rows of one group in one second: tasks and heats send no more than n rows of it each."""
    from zonetally.operators import newest

    monkeypatch.setattr(newest, "HEATS", 4)
    df = spark.range(0, 1_000_000, 1, 20).select(F.lit("hot").alias("g"), F.lit(5.0).alias("t"), "id")
    out = newest_of_many(df, ["g"], "t", "id", 50)
    assert sorted(r["id"] for r in out.collect()) == list(range(999_950, 1_000_000))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4
    sent = newest._round(df.withColumn("_heat", F.spark_partition_id() % 4), ["g", "_heat"], "t", "id", 50)
    assert sent.count() == 4 * 50
    top = newest_overall(df, "t", "id", 50)
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString() and top.count() == 50


def test_exact_percentiles(spark):
    rng = np.random.default_rng(5)
    data = {"one": [3.5], "two": [1.0, 2.0], "wide": list(rng.lognormal(2, 3, 500)), "equal": [4.0] * 50,
            "signs": list(rng.normal(0, 100, 301)), "tiny": list(rng.random(99) * 1e-6)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs] + [("wide", None), ("none", None)], "g string, v double")
    got = {r["g"]: r for r in exact_percentiles(df, ["g"], "v", digits=12).collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        for name, p in (("p50", 50), ("p95", 95), ("p99", 99)):
            assert got[k][name] == pytest.approx(np.percentile(vs, p), rel=1e-9, abs=1e-11)


# ---- reuse --------------------------------------------------------------------

def chain(times, ttl_us):
    """The requests of one key, walked in order."""
    until, out = None, []
    for i, t in enumerate(times):
        miss = until is None or t >= until
        if miss:
            until = t + ttl_us
        out.append("MISS" if miss else "HIT")
    return out


def test_reuse_at_the_very_end_misses(spark):
    df = spark.createDataFrame([(1, "k", 0.0), (2, "k", 9.999999), (3, "k", 10.0), (4, "k", 19.9), (5, "k", 20.0)], "request_id bigint, cache_key string, at double")
    out = ttl.hit_or_miss(df, "at", F.lit(10), "request_id").orderBy("request_id").collect()
    assert [r["cache"] for r in out] == ["MISS", "HIT", "MISS", "HIT", "MISS"]


@pytest.mark.parametrize("batch", ["3", "50", "10000"])
def test_reuse_chain_matches_walk(spark, batch):
    """Dense and sparse keys over many chunks, with Arrow batches that cut groups."""
    rng = np.random.default_rng(int(batch))
    rows, i = [], 0
    for key, n, span in (("dense", 1500, 3000), ("medium", 300, 20000), ("sparse", 40, 100000), ("single", 1, 10), ("burst", 200, 5)):
        for t in np.sort(np.round(rng.random(n) * span, 6)):
            rows.append((i, key, float(t)))
            i += 1
    rows += [(i + j, "same", 5.0) for j in range(4)]
    df = spark.createDataFrame(rows, "request_id bigint, cache_key string, at double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = {r["request_id"]: r["cache"] for r in ttl.hit_or_miss(df, "at", F.lit(10), "request_id").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for key in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == key]
        us = [round(r[2] * 1e6) for r in mine]
        assert [got[r[0]] for r in mine] == chain(us, 10_000_000), key


def test_one_key_with_most_rows(spark):
    """Nine of ten requests have one key: they are linked without bringing a key's records together."""
    rng = np.random.default_rng(8)
    rows = [(i, "hot" if i % 10 else f"k{i % 70}", float(t)) for i, t in enumerate(np.round(rng.random(20_000) * 40_000, 3))]
    df = spark.createDataFrame(rows, "request_id bigint, cache_key string, at double")
    out = ttl.hit_or_miss(df, "at", F.lit(10), "request_id")
    got = {r["request_id"]: r["cache"] for r in out.collect()}
    for key in {"hot", "k0", "k10"}:
        mine = sorted((round(t * 1e6), i) for i, k, t in rows if k == key)
        assert [got[i] for _, i in mine] == chain([us for us, _ in mine], 10_000_000), key
    times = df.select("cache_key", F.floor(F.col("at") / (10 * ttl.CHUNK_TTLS)).alias("chunk")).groupBy("cache_key", "chunk").count()
    assert times.agg(F.max("count")).first()[0] <= 0.01 * len(rows)


def test_requests_without_key_or_time_are_no_hits(spark):
    rows = [(1, "a", 0.0), (2, None, 1.0), (3, "a", None), (4, None, None), (5, "a", 1.0), (6, "a", 0.0)]
    df = spark.createDataFrame(rows, "request_id bigint, cache_key string, at double")
    got = {r["request_id"]: r["cache"] for r in ttl.hit_or_miss(df, "at", F.lit(10), "request_id").collect()}
    assert got == {1: "MISS", 2: None, 3: None, 4: None, 5: "HIT", 6: "HIT"}


# ---- backlog ------------------------------------------------------------------

def peak_and_recovery(points):
    """By definition: peaks are new maxima above zero; a recovery is the first zero after a peak, counted from the last
    peak before it; the newest recovery is reported; a backlog drains while its last peak has none."""
    t, v = np.array([p[0] for p in points]), np.array([p[1] for p in points])
    earlier = np.maximum.accumulate(np.append(0, v))[:-1]
    peaks, zeros = np.flatnonzero(v > earlier), np.flatnonzero(v == 0)
    if not len(peaks):
        return 0, None, None, False
    last = peaks[-1]
    recoveries = [zeros[zeros > p][0] for p in peaks if (zeros > p).any()]
    done = None
    if recoveries:
        newest = max(recoveries)
        done = round(t[newest] - t[peaks[peaks < newest][-1]], 2)
    return v.max(), t[last], done, not (zeros > last).any()


def test_recovery(spark, ranges):
    rng = np.random.default_rng(11)
    series = {"two drains": [0, 3, 1, 0, 2, 0, 5, 4, 0, 1], "never": [1, 2, 3], "flat": [0, 0, 0], "old value stays": [4, 0, 6, 1],
              "random": [int(x) for x in np.maximum(0, rng.integers(-6, 12, 200))]}
    rows = [(k, float(t) * 1.5, int(v)) for k, vs in series.items() for t, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k string, t double, total bigint")
    got = {r["k"]: r for r in B.recovery(df, "k").collect()}
    for k in series:
        points = [(t, v) for kk, t, v in rows if kk == k]
        peak, peak_t, done, draining = peak_and_recovery(points)
        r = got[k]
        assert (r["peak_backlog"], r["peak_time"], r["recovery_time_sec"], r["draining"]) == (peak, peak_t, done, draining), k
        assert r["backlog_total"] == points[-1][1]


def test_lag_without_commit_counts_from_zero(spark):
    df = spark.createDataFrame([("p", "main", 0, 10, None), ("p", "main", 1, 10, 4), ("p", "main", 2, 3, 5), ("p", "main", 3, 7, -1)],
                               "poll_ts string, topic string, part int, high_offset bigint, committed_offset bigint")
    assert B.topic_lag(df).first()["lag"] == 10 + 6 + 0 + 7


def test_counter_rate_needs_a_time_step(spark, rows_of):
    df = spark.createDataFrame([("a", 0.0, 5), ("a", 30.0, 8), ("a", 30.0, 9)], "source string, t double, n bigint")
    out = K.counter_rate(df.where("n < 9"), "source", "t", "n", "rate")
    assert rows_of(out, "t") == [("a", 0.0, 5, None), ("a", 30.0, 8, 6.0)]
