"""Connected components of a table of links, without gathering them anywhere.

Each task first runs union-find over the links it holds. Then rounds of two
steps follow, till nothing changes: every node points its larger neighbours at
the smallest node it knows, then its smaller ones. Rounds are stored, so a lost
executor costs no more than a round.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonetally.session import store


def _find(parent: dict[int, int], x: int) -> int:
    root = x
    while parent[root] != root:
        root = parent[root]
    while parent[x] != root:
        parent[x], x = root, parent[x]
    return root


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = _find(parent, parent.setdefault(a, a)), _find(parent, parent.setdefault(b, b))
            parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if parent[x] != x]
    for k in range(0, len(nodes), 50_000):
        some = nodes[k:k + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([_find(parent, x) for x in some], pa.int64())], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link, but for roots themselves; root is the smallest node reachable.

    links: two columns of longs. Loops, repeated and turned links don't matter.
    """
    spark = links.sparkSession
    a, b = links.columns
    now = store(spark, links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").mapInArrow(_united, "a long, b long"), "links")
    state = None
    while True:
        found = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if found.n == 0 or state == (found.n, found.h):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = (found.n, found.h)
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))  # a's neighbours b
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = store(spark, small.union(lower.select("a", F.col("m").alias("b"))).distinct(), "links")
