import numpy as np
import pytest
from pyspark.sql import functions as F

from zonetally import schemas
from zonetally.functions import columns as C
from zonetally.operators import kpis as K
from zonetally.operators import sketches as SK


def records(spark, rows):
    df = spark.createDataFrame([(t, "Q1", cache, latency, retries, "processed") for t, cache, latency, retries in rows], schemas.METRIC_RECORD)
    return df.withColumn("event_time", C.event_time())


def by_window(df):
    return {r["window_start"]: tuple(r) for r in df.collect()}


def test_windows_of_panes_equal_windows_of_records(spark):
    rng = np.random.default_rng(3)
    rows = [(1000.0 + float(rng.integers(0, 900)), ["HIT", "MISS", None][rng.integers(3)],
             None if rng.random() < 0.1 else float(np.round(rng.random() * 50, 1)), [None, 0, 1, 2][rng.integers(4)]) for _ in range(600)]
    df = records(spark, rows + [(None, "HIT", 1.0, 0)])
    panes = SK.window_panes(df).cache()
    for length, slide in ((60, 30), (30, 30), (300, 60), (600, 600)):
        want = by_window(K.window_kpis(df, length=f"{length} seconds", slide=f"{slide} seconds"))
        got = by_window(SK.windows_of_panes(panes, 30, length, slide))
        assert got.keys() == want.keys()
        for k in want:
            assert got[k][:2] == want[k][:2] and got[k][2:] == pytest.approx(want[k][2:])


def test_window_without_latencies_and_empty_table(spark):
    df = records(spark, [(1000.0, "HIT", None, 1), (1001.0, None, float("nan"), None)])
    (r,) = SK.windows_of_panes(SK.window_panes(df, seconds=60), 60, 60, 60).collect()
    assert (r["events_in_window"], r["p50_ms"], r["p95_ms"], r["hit_rate"], r["retried_share"]) == (2, None, None, 0.5, 0.5)
    assert SK.windows_of_panes(SK.window_panes(df.limit(0)), 30, 60, 30).collect() == []


@pytest.mark.parametrize("pane,length,slide", [(30, 45, 30), (30, 60, 45), (0, 60, 30), (30, 30, 60), (30, 60, 0)])
def test_windows_that_cut_panes_are_refused(spark, pane, length, slide):
    with pytest.raises(ValueError, match="panes"):
        SK.windows_of_panes(spark.range(0), pane, length, slide)


def test_records_are_not_copied_into_windows(spark):
    plan = SK.window_panes(records(spark, [(1000.0, "HIT", 1.0, 0)]))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan


@pytest.mark.parametrize("values", ["rand(5)", "exp(rand(5) * 20)", "floor(rand(5) * 7)", "cast(id as double)"])
def test_rank_errors_of_merged_sketches(spark, values):
    """Sketches of 400 uneven panes, one of which holds half of the rows."""
    df = spark.range(200_000).selectExpr(f"cast({values} as double) as v", "case when id % 2 = 0 then 0 else pmod(hash(id), 400) end as pane").cache()
    merged = df.groupBy("pane").agg(SK.quantile_sketch("v").alias("s")).agg(SK.merged_quantiles("s").alias("s"))
    shares = (0.01, 0.5, 0.95, 0.99)
    got = merged.select(*[SK.quantile("s", q).alias(f"q{i}") for i, q in enumerate(shares)]).first()
    v = np.sort([r[0] for r in df.select("v").collect()])
    for q, x in zip(shares, got):
        assert np.searchsorted(v, x, "left") / len(v) <= q + 0.01 and np.searchsorted(v, x, "right") / len(v) >= q - 0.01


def test_distinct_keys_of_any_set(spark):
    df = spark.range(300_000).selectExpr(
        "case when id % 50 = 0 then null else concat('k', pmod(hash(id), 40000 + 1000 * (id % 7))) end as cache_key", "id % 7 as day",
        "case when id % 3 = 0 then null else id % 3 end as run").cache()
    sketches = SK.distinct_sketches(df, ["day", "run"]).cache()
    for chosen in ("day = 2", "day in (1, 3, 5)", "true", "run is null"):
        exact = df.where(chosen).agg(F.count_distinct("cache_key"), F.count(F.lit(1))).first()
        (r,) = SK.distinct_of(sketches.where(chosen), [F.lit(1).alias("all")]).collect()
        assert r["n_keys"] == pytest.approx(exact[0], rel=0.03) and r["n"] == exact[1]
    assert {r["run"] for r in SK.distinct_of(sketches, ["run"]).collect()} == {None, 1, 2}


def test_groups_without_keys_and_empty_table(spark):
    df = spark.createDataFrame([("a", None), ("b", "x"), ("b", "x")], "run string, cache_key string")
    assert {tuple(r) for r in SK.distinct_of(SK.distinct_sketches(df, ["run"]), ["run"]).collect()} == {("a", 0, 1), ("b", 1, 2)}
    assert SK.distinct_sketches(df.limit(0), ["run"]).collect() == []
