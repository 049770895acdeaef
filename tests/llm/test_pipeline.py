"""The pipeline against a plain version of each stage on a small table."""

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from cases import prose

import corpus_pipeline as cp


@pytest.fixture
def tables(tmp_path):
    item = prose(900, 25)
    rows = [(k, prose(k, 90)) for k in range(20)]
    rows += [(20, prose(3, 90) + " more"), (21, f"{prose(21, 60)} {item} {prose(22, 30)}"), (22, "spam " * 80), (23, "too short"), (24, None), (25, ""),
             (26, f"{prose(26, 80)} write me@mail.org now"), (27, prose(0, 90)), (None, prose(28, 90)), (29, prose(29, 3000))]
    docs = pa.table({"doc_id": pa.array([k for k, _ in rows], pa.int64()), "text": [t for _, t in rows], "lang": ["en"] * len(rows), "source": ["s"] * len(rows),
                     "n_chars": pa.array([len(t or "") for _, t in rows], pa.int64())})
    pq.write_table(docs, f"{tmp_path}/documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array([1], pa.int64()), "text": [item]}), f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows


def test_stages(spark, tables, tmp_path):
    folder, rows = tables
    docs, ids = spark.read.parquet(f"{folder}/documents.parquet"), []
    columns = docs.columns
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == len(cp.STAGES) - 1 or docs.columns == columns
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
    everything = {k for k, _ in rows}
    assert ids[0] == everything - {22, 23, 24, 25}
    assert ids[1] == ids[0] - {20, 27}
    assert ids[2] == ids[1] - {21}
    assert ids[3] == ids[4] == ids[2]
    masked = {r.doc_id: r for r in spark.read.parquet(f"{tmp_path}/3").collect()}
    assert masked[26].text == f"{prose(26, 80)} write [EMAIL] now" and masked[26].n_chars == len(masked[26].text)
    assert masked[5].text == prose(5, 90)


def test_columns_with_inner_names_stay(spark, tables, tmp_path):
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr(
        "*", *(f"concat('{c}-', doc_id) as `{c}`" for c in ("base", "spans", "host", "row", "document", "more", "bands", "tag")))
    first = {r.doc_id: r.asDict() for r in docs.collect() if r.doc_id is not None}
    for k, (_, stage) in enumerate(cp.STAGES[:-1]):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/any-{k}")
        again = spark.read.parquet(f"{tmp_path}/any-{k}")
        assert again.schema == docs.schema
        docs = again
    last = {r.doc_id: r.asDict() for r in docs.collect() if r.doc_id is not None}
    changed = {"text", "n_chars"}
    assert len(last) > 15 and all({c: v for c, v in row.items() if c not in changed} == {c: v for c, v in first[k].items() if c not in changed} for k, row in last.items())


def test_run(spark, tables):
    folder, _ = tables
    got, tokens = cp.run(spark, folder).collect(), defaultdict(int)
    for r in got:
        tokens[r.doc_id] += len(np.frombuffer(r.ids, "<u4"))
    assert all(tokens[r.doc_id] == r.doc_tokens for r in got) and 29 in tokens and 22 not in tokens
