"""Every registered query against its SQL."""

import pytest
from compare import check, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "events_in_window", "p50_ms", "p95_ms", "hit_rate", "retried_share"]
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(entry.queries()) - set(entry.oracle_sql()) == set(entry.LLM_QUERIES) - set(entry.LLM_SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(entry.LLM_SQL)))
def test_same_rows(spark, duck, name):
    assert check(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name]) == ""


def test_documents_hold_all_evictions(spark):
    """Each scenario's counter at its last poll has counted all its misses."""
    from zonetally.plans.fixtures import query_events

    misses = query_events(spark, SF).where("event = 'miss'").groupBy("scenario").count().collect()
    got = entry.queries()["jn07_documents_with_evictions"](spark, SF).collect()
    assert {r.label: r.total_evicted for r in got} == {r["scenario"]: r["count"] for r in misses}
