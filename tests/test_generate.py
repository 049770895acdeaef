import numpy as np
import pytest
from pyspark.sql import functions as F

from zonetally.functions import columns as C
from zonetally.functions import domains as D
from zonetally.operators import generate as G


@pytest.fixture(scope="module")
def items(spark):
    ids = spark.range(0, 3000, 3).select((F.col("id") * 7 % 3001).alias("item"))
    ranked = G.rank_by(ids, "item")
    return G.zipf_probabilities(ranked, "rank", 1.2)


def test_ranks_and_probabilities(items):
    rows = items.orderBy("item").collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    weights = np.arange(1, len(rows) + 1) ** -1.2
    assert np.allclose([r["probability"] for r in rows], weights / weights.sum())
    assert sum(r["probability"] for r in rows) == pytest.approx(1.0)


def test_intervals_cover_the_unit_interval(items):
    rows = G.cumulative_intervals(items, "rank").orderBy("rank").collect()
    assert rows[0]["lo"] == 0.0 and rows[-1]["hi"] == 1.0
    assert all(a["hi"] == b["lo"] for a, b in zip(rows, rows[1:]))


def test_every_draw_gets_one_item(spark, items):
    intervals = G.cumulative_intervals(items, "rank")
    draws = spark.range(20000).select("id", C.uniform01("t", F.col("id")).alias("u"))
    edge = spark.createDataFrame([(-1, 0.0), (-2, 1.0 - 2 ** -52)], "id bigint, u double")
    out = G.sample_items(draws.unionByName(edge), "u", intervals)
    assert out.count() == 20002 and out.select("id").distinct().count() == 20002
    share = out.where("rank = 1").count() / 20002
    assert share == pytest.approx(items.where("rank = 1").first()["probability"], abs=0.02)


def test_uniform_numbers(spark):
    r = spark.range(20000).select(C.uniform01(F.lit(1), F.col("id")).alias("u")).agg(
        F.min("u").alias("lo"), F.max("u").alias("hi"), F.avg("u").alias("mean"), F.stddev("u").alias("sd")).first()
    assert 0 <= r["lo"] and r["hi"] < 1 and r["mean"] == pytest.approx(.5, abs=.01) and r["sd"] == pytest.approx(12 ** -.5, abs=.01)


def test_spike_changes_the_rate(spark):
    gap = G.unit_gap(C.uniform01("s", F.col("id")))
    rows = G.arrival_times(spark.range(5000), "id", gap, F.floor(F.col("id") / 100), 10.0, 20.0, 100.0).orderBy("id").collect()
    at = [r["arrival_sec"] for r in rows]
    assert at[0] == 0.0 and all(b >= a for a, b in zip(at, at[1:]))
    # step by step: the rate of each wait depends on the time before it
    gaps = [r["g"] for r in spark.range(5000).select("id", gap.alias("g")).orderBy("id").collect()]
    t, want = 0.0, []
    for g in gaps:
        want.append(t)
        t += g / (100.0 if t >= 20.0 else 10.0)
    assert np.allclose(at, want)


@pytest.mark.parametrize("kind", ["zipf", "uniform"])
def test_requests_are_valid(spark, kind):
    df = G.build_requests(spark.range(4000), "id", kind).cache()
    assert df.count() == 4000
    assert df.where("query_type = 'Q4' and (zone_b is null or zone_a = zone_b)").count() == 0
    assert df.where("query_type <> 'Q4' and zone_b is not null").count() == 0
    assert df.where("(query_type = 'Q5') <> (bins is not null)").count() == 0
    assert df.where("(query_type = 'Q5') = (confidence_min is not null)").count() == 0
    counts = {r["query_type"]: r["count"] for r in df.groupBy("query_type").count().collect()}
    top = counts["Q1"] / 4000
    want = 1 / sum(C.zipf_weights(5, 1.2)) if kind == "zipf" else 0.2
    assert top == pytest.approx(want, abs=0.03) and set(counts) == set(D.QUERY_TYPES)


def test_unknown_distribution(spark):
    with pytest.raises(ValueError):
        G.build_requests(spark.range(1), "id", "pareto")
