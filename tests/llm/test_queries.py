"""Every registered query of the subpackage on the smallest tables."""

import pytest

import __spark_entry__ as entry
from zonetally.llm.queries import QUERIES

COLUMNS = {
    "op1": "doc_id start n_tokens ids_crc32", "op2": "doc_id slot shard", "op3": "doc_id n_shingles component_id kept", "op4": "page_id url text n_chars",
    "op5": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", "op6": "doc_id held_out score predicted",
    "op7": "doc_id n_words n_removed kept_sha256", "op8": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op11": "anchor_id positive_id rank negative_id positive_score negative_score", "op12": "item_id rank doc_id score",
    "op13": "doc_id size source_size target taken",
    "op9": "doc_id n_email n_ip n_card n_phone base_sha256 spans", "op10": "doc_id item_id score",
}


def test_all_are_registered():
    assert {q.split("_")[0] for q in QUERIES} == set(COLUMNS) and set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, name):
    sf = "/root/testdata/sf0.001"
    got = entry.queries()[name](spark, sf)
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(got.columns)
    n = got.count()
    if name.startswith("op4"):
        assert n == spark.read.parquet(f"{sf}/pages.parquet").count()
    elif not name.startswith(("op8", "op10", "op11", "op12")):
        assert n == spark.read.parquet(f"{sf}/documents.parquet").count()


@pytest.mark.parametrize("name", sorted(entry.LLM_SQL))
def test_same_rows_as_sql(spark, name):
    from compare import check, connect

    sf = "/root/testdata/sf0.001"
    assert check(entry.queries()[name](spark, sf), connect(sf), entry.LLM_SQL[name]) == ""
