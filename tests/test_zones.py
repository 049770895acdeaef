import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonetally import schemas
from zonetally.functions import columns as C
from zonetally.functions import domains as D
from zonetally.operators import requests as R
from zonetally.operators import zones as Z

NAN = float("nan")


@pytest.fixture(scope="module")
def zones(spark):
    return Z.zone_dimension(spark)


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.BUILDINGS)


def test_area_is_flat_box(zones):
    got = {r["zone_id"]: r["area_km2"] for r in zones.collect()}
    for zid, _name, a, b, c, d in D.ZONES:
        want = abs((b - a) * 111.32 * (d - c) * 111.32 * math.cos(math.radians((a + b) / 2)))
        assert got[zid] == pytest.approx(want, rel=1e-12)


def test_floor_zero_keeps_null_and_nan(spark, zones):
    b = frame(spark, [("Z1", None, 1.0), ("Z1", NAN, 2.0), ("Z1", 0.5, 3.0), ("Z9", 0.5, 4.0)])

    def counts(floor):
        return {r["zone_id"]: r["count"] for r in Z.building_count(b, zones, floor).collect()}

    assert counts(0.0)["Z1"] == 3 and counts(-1.0)["Z1"] == 3
    assert counts(0.5)["Z1"] == 1 and counts(0.51)["Z1"] == 0
    assert counts(0.0)["Z2"] == 0 and "Z9" not in counts(0.0)
    kept = b.where(C.keeps(F.col("confidence"), F.lit(0.2))).count()
    assert kept == 2 and b.where(C.keeps(F.col("confidence"), F.lit(0.0))).count() == 4


def test_empty_zone_has_zero_areas(spark, zones):
    row = Z.area_totals(frame(spark, []), zones).where("zone_id = 'Z3'").first()
    assert (row["avg_area"], row["total_area"], row["n"]) == (0.0, 0.0, 0)


def test_unknown_zone_is_an_error(spark, zones):
    with pytest.raises(ValueError):
        Z.one_zone(frame(spark, []), zones, "Z6")


def test_zones_come_from_the_table(spark):
    six = Z.zone_dimension(spark, [("Z9", "Ninth", 0.0, 1.0, 0.0, 1.0)])
    b = frame(spark, [("Z9", 0.5, 1.0), ("Z9", 0.7, 2.0), ("Z1", 0.5, 3.0), ("Z8", 0.5, 4.0)])
    assert {r["zone_id"]: r["count"] for r in Z.building_count(b, six).collect() if r["count"]} == {"Z1": 1, "Z9": 2}
    assert {r["zone_id"]: r["buildings"] for r in Z.building_totals(b, six).collect()} == {"Z1": 1, "Z9": 2, "all": 3}
    assert Z.compare_zones(Z.density(b, six)).count() == 30 and Z.other_zones(six).count() == 30
    assert Z.one_zone(b, six, "Z9").count() == 2
    assert sum(r["count"] for r in Z.confidence_histogram(b, six, 4).collect()) == 3
    q = spark.createDataFrame([(1, "Q1", "Z9", None, 0.6, None), (2, "Q1", "Z8", None, 0.0, None)],
                              "request_id bigint, query_type string, zone_a string, zone_b string, confidence_min double, bins int")
    assert [(r["request_id"], r["n"]) for r in R.answer_requests(q, b, six).collect()] == [(1, 1)]
    assert [r["reject_reason"] for r in R.with_reject_reason(q, six).orderBy("request_id").collect()] == [None, "unknown zone"]


def test_no_request_is_lost(spark, zones):
    b = frame(spark, [("Z1", 0.5, 1.0), ("Z1", NAN, 2.0), ("Z1", None, 3.0), ("Z2", 0.9, 1.0)])
    rows = [(1, "Q1", "Z1", None, None, None), (2, "Q1", "Z1", None, NAN, None), (3, "Q5", "Z1", None, None, 0), (4, "Q5", "Z1", None, NAN, None),
            (5, "Q5", "Z1", None, None, -3), (6, "Q5", "Z1", None, None, 100_000), (7, "Q4", "Z1", "Z2", 0.5, None), (8, None, "Z1", None, 0.1, None),
            (9, "Q4", "Z1", None, 0.5, None), (10, "Q2", "Z3", None, 0.3, None)]
    q = spark.createDataFrame(rows, "request_id bigint, query_type string, zone_a string, zone_b string, confidence_min double, bins int")
    got = {r["request_id"]: r for r in R.answer_requests(q, b, zones).collect()}
    why = {r["request_id"]: r["reject_reason"] for r in R.with_reject_reason(q, zones).where("reject_reason is not null").collect()}
    assert why == {2: "floor is not a number", 3: "bins must be positive", 5: "bins must be positive", 8: "unknown query type", 9: "second zone missing"}
    assert set(got) | set(why) == set(range(1, 11)) and not set(got) & set(why)
    assert got[1]["n"] == 3 and [x["count"] for x in got[4]["buckets"]] == [0, 0, 1, 0, 0] and got[7]["winner"] in ("Z1", "Z2")
    assert len(got[6]["buckets"]) == 100_000 and got[6]["buckets"][50_000]["count"] == 1 and (got[10]["n"], got[10]["avg_area"]) == (0, 0.0)


def test_tie_goes_to_second_zone(spark, zones):
    pairs = Z.compare_zones(Z.density(frame(spark, []), zones)).collect()
    assert len(pairs) == 20 and all(r["winner"] == r["zone_b"] for r in pairs)


@pytest.mark.parametrize("bins", [1, 3, 5, 7, 10, 12, 20, 49])
def test_histogram_matches_numpy(spark, zones, bins):
    rng = np.random.default_rng(bins)
    edges = np.linspace(0, 1, bins + 1)
    xs = np.concatenate([rng.random(300), edges, [0.3, 0.1, 0.7, 1.0, -0.1, 1.1], np.round(rng.random(200), 2)])
    b = frame(spark, [("Z1", float(x), 1.0) for x in xs] + [("Z1", None, 1.0), ("Z1", NAN, 1.0)])
    got = [r["count"] for r in Z.confidence_histogram(b, zones, bins).where("zone_id = 'Z1'").orderBy("bucket").collect()]
    assert got == np.histogram(xs, bins=bins, range=(0.0, 1.0))[0].tolist()


def test_histogram_arrays_are_ordered(spark, zones):
    b = frame(spark, [("Z1", 0.95, 1.0), ("Z1", 0.05, 1.0)])
    row = Z.histogram_arrays(Z.confidence_histogram(b, zones, 10)).where("zone_id = 'Z1'").first()
    assert [x["bucket"] for x in row["buckets"]] == list(range(10))
    assert [x["count"] for x in row["buckets"]] == [1] + [0] * 8 + [1]


def test_counts_fall_with_the_floor(spark, zones):
    rng = np.random.default_rng(1)
    b = frame(spark, [("Z4", float(x), 1.0) for x in rng.random(500)])
    counts = [Z.building_count(b, zones, f).where("zone_id = 'Z4'").first()["count"] for f in (0.0, 0.2, 0.5, 0.9, 1.1)]
    assert counts == sorted(counts, reverse=True) and counts[0] == 500 and counts[-1] == 0


def request_rows(rng, n):
    kinds = ["Q1", "q2", "Q3", "Q4", "Q5", "Q9"]
    rows = []
    for i in range(n):
        a, b = rng.choice(5, 2, replace=False)
        floor = float(rng.choice([0.0, -0.5, 0.35, 0.29, 1.0, 1.2, 0.005, 1 / 3, rng.random()]))
        rows.append((i, str(rng.choice(kinds)), f"Z{a + 1}", f"Z{b + 1}", floor, int(rng.choice([1, 3, 10, 64, 65, 70]))))
    return rows


def test_answers_match_brute_force(spark, zones):
    rng = np.random.default_rng(7)
    b = [(f"Z{rng.integers(1, 7)}", float(x), float(a)) for x, a in zip(np.round(rng.random(400), 3), rng.random(400) * 100)]
    b += [("Z1", 1.0, 5.0), ("Z1", 1.0, 6.0), ("Z2", 0.35, 7.0), ("Z2", 0.29, 8.0), ("Z2", 0.0, 9.0), ("Z3", 1.3, 2.0),
          ("Z3", -0.2, 3.0), ("Z4", None, 4.0), ("Z4", NAN, 4.5)]
    asked = request_rows(rng, 250)
    requests = spark.createDataFrame(
        asked, "request_id bigint, query_type string, zone_a string, zone_b string, confidence_min double, bins int")
    got = {r["request_id"]: r for r in R.answer_requests(requests, frame(spark, b), zones).collect()}
    area = {r["zone_id"]: r["area_km2"] for r in zones.collect()}

    def rows(zone, floor):
        return [r for r in b if r[0] == zone and (floor <= 0 or (r[1] is not None and r[1] >= floor))]

    valid = [r for r in asked if r[1].upper() != "Q9"]
    assert set(got) == {r[0] for r in valid}
    for i, kind, za, zb, floor, bins in valid:
        answer, kind = got[i], kind.upper()
        if kind == "Q5":
            xs = [r[1] for r in b if r[0] == za and r[1] is not None and not math.isnan(r[1])]
            assert [x["count"] for x in answer["buckets"]] == np.histogram(xs, bins=bins, range=(0, 1))[0].tolist()
            continue
        n = len(rows(za, floor))
        if kind == "Q4":
            da, db = n / area[za], len(rows(zb, floor)) / area[zb]
            assert answer["density_a"] == pytest.approx(da) and answer["density_b"] == pytest.approx(db)
            assert answer["winner"] == (za if da > db else zb)
            continue
        assert answer["n"] == n
        if kind == "Q2":
            assert answer["total_area"] == pytest.approx(sum(r[2] for r in rows(za, floor)))
        if kind == "Q3":
            assert answer["density_a"] == pytest.approx(n / area[za])


def test_answers_read_buildings_once(spark, zones):
    """Requests on cell edges meet the stored counts, not the buildings."""
    b = frame(spark, [("Z1", 0.5, 1.0)]).withColumn("area_in_meters", F.col("area_in_meters") + F.rand() * 0)
    requests = spark.createDataFrame(
        [(1, "Q1", "Z1", "Z2", 0.5, 5), (2, "Q5", "Z1", "Z2", 0.0, 5)],
        "request_id bigint, query_type string, zone_a string, zone_b string, confidence_min double, bins int")
    plan = R.answer_requests(requests, b, zones)._jdf.queryExecution().optimizedPlan().toString()
    assert "rand(" not in plan


def test_request_keys(spark):
    df = spark.createDataFrame(
        [("q1", "Z1", None, 0.8, None), ("Q4", "Z1", "Z2", None, None), ("Q4", "Z2", "Z1", 0.05, None), ("Q5", "Z3", None, None, None),
         ("Q9", "Z1", None, 0.1, 3)], "query_type string, zone_a string, zone_b string, confidence_min double, bins int")
    keys = [r["cache_key"] for r in R.with_key(df).collect()]
    assert keys == ["count:Z1:conf=0.80", "compare:density:Z1:Z2:conf=0.00", "compare:density:Z2:Z1:conf=0.05",
                    "confidence_dist:Z3:bins=5", None]
