import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from zonetally import schemas
from zonetally.functions import columns as C
from zonetally.operators import requests as R
from zonetally.session import scratch_root, store
from zonetally.sources import readers, writers


def test_missing_buildings_are_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        readers.read_buildings(spark, str(tmp_path / "none"))


def test_scan_pushes_filter_and_columns(spark, tmp_path):
    path = str(tmp_path / "b")
    spark.createDataFrame([("Z1", 0.5, 1.0)], schemas.BUILDINGS).withColumn("other", F.lit(1)).write.parquet(path)
    df = readers.read_buildings(spark, path).where("zone_id = 'Z1' and confidence >= 0.4").select("zone_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(confidence,0.4)" in plan and "EqualTo(zone_id,Z1)" in plan
    assert "area_in_meters" not in plan and "other" not in plan


def test_snapshot_files_of_both_forms(spark, tmp_path):
    body = {"totals": {"hits": 4}, "hit_rate": 0.25, "by_query": {"Q1": {"hits": 1, "p50_ms": None}}, "extra": {"mode": "kafka", "rate": 60.0}}
    (tmp_path / "snap_one.json").write_text(json.dumps({"path": "x", "summary": body}, indent=2))
    (tmp_path / "snap_two.json").write_text(json.dumps({"label": "named", **body}, indent=2))
    docs = readers.read_snapshots(spark, str(tmp_path / "snap_one.json"), str(tmp_path / "snap_two.json"), str(tmp_path / "snap_gone.json"))
    got = {r["label"]: (r["totals"]["hits"], r["hit_rate"], r["by_query"]["Q1"]["hits"], r["extra"]["mode"], r["async_kpis"]) for r in docs.collect()}
    assert got == {"one": (4, 0.25, 1, "kafka", None), "named": (4, 0.25, 1, "kafka", None)}
    assert readers.read_snapshots(spark, str(tmp_path / "nothing.json")).count() == 0


def test_saving_a_label_again_replaces_it(spark, tmp_path):
    path = str(tmp_path / "docs")
    first = spark.createDataFrame([("a b/c", 0.1), ("other", 0.2)], "label string, hit_rate double")
    writers.save_snapshots(first, path)
    writers.save_snapshots(first.where("label <> 'other'").withColumn("hit_rate", F.lit(0.9)), path)
    assert {(r["label"], r["hit_rate"]) for r in readers.read_snapshots(spark, path).collect()} == {("a b/c", 0.9), ("other", 0.2)}
    assert (tmp_path / "docs" / "label_dir=a_b_c").is_dir()


def test_json_with_a_wrong_type_keeps_the_row(spark):
    df = spark.createDataFrame([('{"ts": "x", "cache": "HIT"}',), ("nope",), ('{"ts": 1}',)], "value string")
    rows = [tuple(r)[:3] for r in readers.parse_json(df, schemas.METRIC_RECORD).collect()]
    assert rows == [(None, None, "HIT"), (None, None, None), (1.0, None, None)]
    good, bad = readers.split_json(df)
    assert good.count() == 2 and [r["value"] for r in bad.collect()] == ["nope"]


def test_events_need_a_kind(spark):
    df = spark.createDataFrame([('{"event": "hit", "latency_ms": 2}',), ('{"latency_ms": 2}',)], "value string")
    assert [r["event"] for r in readers.read_events(df).collect()] == ["hit"]


def test_defaults_of_parameters(spark):
    df = spark.createDataFrame([(1, "Q1", '{"zone_id": "Z1"}', None), (2, "Q5", '{"zone_id": "Z2", "bins": 8, "confidence_min": 0.5}', 2)],
                               "request_id int, query_type string, params string, retry_count int")
    out = R.typed_params(df, schemas.REQUEST_PARAMS).orderBy("request_id").select("confidence_min", "bins", "retry_count").collect()
    assert [tuple(r) for r in out] == [(0.0, 5, 0), (0.5, 8, 2)]


def test_small_expressions(spark):
    df = spark.createDataFrame([("", "Z2"), (None, None), ("Z1", "Z2")], "zone_id string, zone_a string")
    assert [r[0] for r in df.select(C.partition_key(F.col("zone_id"), F.col("zone_a"))).collect()] == ["Z2", "Z0", "Z1"]
    types = spark.createDataFrame([("q3",), ("Q5",), ("Q9",)], "q string")
    assert [r[0] for r in types.select(C.time_to_live(F.col("q"))).collect()] == [180, 600, 300]
    assert spark.range(1).select(C.safe_label(F.lit("a/b c"))).first()[0] == "a_b_c"


def test_topic_records_carry_json(spark):
    df = spark.createDataFrame([("Z1", 1)], "zone string, n int")
    r = writers.topic_records(df, "main", F.col("zone")).first()
    assert (r["key"], json.loads(r["value"]), r["topic"]) == ("Z1", {"zone": "Z1", "n": 1}, "main")
    assert writers.topic_records(df, "metrics").first()["key"] is None


def test_stored_table_lies_in_the_session_folder(spark):
    df = store(spark, spark.range(3).toDF("n"), "t")
    assert df.count() == 3 and all(scratch_root(spark) in f for f in df.inputFiles())
