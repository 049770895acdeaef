"""HIT or MISS of requests whose answers stay valid for a fixed time.

A MISS stores the answer at its own time. Later requests of that key HIT until
stored + ttl and do not extend it; a request exactly at stored + ttl misses.
So the stores of a key form a chain: each is the first request at or after the
end of the one before.

The chain is sequential, and a single key may hold a large part of all rows, so
it is cut into chunks of several ttl. What a chunk does depends only on when the
last stored answer before it ends, and only the requests of its first ttl can be
its first store. Step 1 records, per chunk, which end time each such entry leads
to. Step 2 walks over those records, key by key, and finds the end time with which
every chunk starts. Step 3 replays all chunks independently. Only times and keys
pass through Python, as sorted Arrow batches; memory holds a batch and one chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonetally.operators import prefix
from zonetally.session import store

CHUNK_TTLS = 16
NEVER = -(2 ** 62)


def _whole_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Re-cut sorted batches so that no group spans two of them."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if pdf.empty:
            continue
        last = np.ones(len(pdf), dtype=bool)
        for k in keys:
            last &= (pdf[k] == pdf[k].iloc[-1]).to_numpy()
        same = bool(held) and all(held[0][k].iloc[0] == pdf[k].iloc[0] for k in keys)
        start = int(np.argmax(last))
        if start == 0 and same:
            held.append(pdf)
            continue
        if start == 0 and held:
            yield pd.concat(held, ignore_index=True)
            held = [pdf]
            continue
        if start > 0:
            yield pd.concat([*held, pdf.iloc[:start]], ignore_index=True)
        held = [pdf.iloc[start:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def _group_numbers(pdf: pd.DataFrame, keys: list[str]) -> np.ndarray:
    change = np.zeros(len(pdf), dtype=bool)
    for k in keys:
        col = pdf[k].to_numpy()
        change[1:] |= col[1:] != col[:-1]
    return np.cumsum(change)


def _first_at_or_after(group: np.ndarray, t: np.ndarray, ask_group: np.ndarray, ask_t: np.ndarray) -> np.ndarray:
    """Index of the first row of `ask_group` with time >= ask_t; its end if there is none."""
    base = t.min()
    width = int(t.max() - base) + 2
    line = group * width + (t - base)
    asked = np.clip(ask_t - base, 0, width - 1)
    return np.searchsorted(line, ask_group * width + asked)


def _summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per chunk: the possible first stores and the end time each one leads to."""
    for pdf in _whole_groups(batches, ["cache_key", "chunk"]):
        g = _group_numbers(pdf, ["cache_key", "chunk"])
        t, ttl = pdf["us"].to_numpy(), pdf["ttl_us"].to_numpy()
        ends = np.searchsorted(g, g, side="right")
        heads = np.searchsorted(g, g)
        start = pdf["chunk"].to_numpy() * ttl * CHUNK_TTLS
        early = t < start + ttl
        # the first request after the first ttl is an entry too: all early ones may have been missed
        entry = early | (np.arange(len(t)) == heads) | np.r_[False, early[:-1] & (g[1:] == g[:-1])]
        idx = np.flatnonzero(entry)
        pos = idx.copy()
        while True:
            nxt = _first_at_or_after(g, t, g[pos], t[pos] + ttl[pos])
            more = nxt < ends[pos]
            if not more.any():
                break
            pos = np.where(more, nxt, pos)
        exits = t[pos] + ttl[pos]
        # neighbours with one exit act as one entry: keep the latest of each run
        keep = np.ones(len(idx), dtype=bool)
        keep[:-1] = (exits[1:] != exits[:-1]) | (g[idx][1:] != g[idx][:-1])
        idx, exits = idx[keep], exits[keep]
        yield pd.DataFrame({"cache_key": pdf["cache_key"].to_numpy()[idx], "chunk": pdf["chunk"].to_numpy()[idx],
                            "entry_us": t[idx], "exit_us": exits})


def _replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Store times of each chunk."""
    for pdf in _whole_groups(batches, ["cache_key", "chunk"]):
        g = _group_numbers(pdf, ["cache_key", "chunk"])
        t, ttl = pdf["us"].to_numpy(), pdf["ttl_us"].to_numpy()
        heads = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        ends = np.searchsorted(g, g, side="right")
        stored = np.zeros(len(t), dtype=bool)
        pos = _first_at_or_after(g, t, g[heads], pdf["valid_until_us"].to_numpy()[heads])
        pos = pos[pos < ends[heads]]
        while len(pos):
            stored[pos] = True
            nxt = _first_at_or_after(g, t, g[pos], t[pos] + ttl[pos])
            pos = nxt[nxt < ends[pos]]
        idx = np.flatnonzero(stored)
        yield pd.DataFrame({"cache_key": pdf["cache_key"].to_numpy()[idx], "stored_us": t[idx]})


def _links(steps: DataFrame) -> DataFrame:
    """Each record with `next`, `after` (its key's next two chunks that have records: chunk, first, last), `passes` (whether
    its end time lies beyond the records of the next) and `to`, the entry that follows from it; null at the end of a key.

    An end time lies less than a ttl inside the chunk behind its own. If all requests there are earlier, that chunk stores nothing and
    the first entry of the one after follows.
    """
    chunks = steps.groupBy("cache_key", "chunk").agg(F.min("entry_us").alias("first"), F.max("entry_us").alias("last"))
    of = F.struct("chunk", "first", "last")
    lead = prefix.previous(chunks.withColumn("_down", -F.col("chunk")), ["cache_key"], ["_down"], {"next": of}).drop("_down")
    lead = store(steps.sparkSession, lead, "chunks")
    beyond = lead.select("cache_key", F.struct("chunk", "next").alias("_of"))
    beyond = beyond.select(F.col("cache_key").alias("_key"), F.col("_of.chunk").alias("_chunk"), F.col("_of.next").alias("after"))
    lead = lead.join(beyond, F.expr("cache_key = _key and next.chunk = _chunk"), "left").select("cache_key", "chunk", "next", "after")
    records = steps.join(lead, ["cache_key", "chunk"]).withColumn("passes", F.col("exit_us") > F.col("next.last"))
    # the first entry at or after each end time: both stand in one order, ends before entries of the same time
    ask = records.where("not passes").select("cache_key", F.col("next.chunk").alias("chunk"), F.col("exit_us").alias("us"), F.col("entry_us").alias("asks"))
    there = steps.select("cache_key", "chunk", F.col("entry_us").alias("us"), F.lit(None).cast("bigint").alias("asks"))
    on = Window.partitionBy("cache_key", "chunk").orderBy("us", F.col("asks").isNull()).rowsBetween(0, Window.unboundedFollowing)
    found = ask.union(there).withColumn("_to", F.min(F.when(F.col("asks").isNull(), F.col("us"))).over(on)).where("asks is not null")
    found = found.select("cache_key", F.col("asks").alias("entry_us"), "_to")
    out = records.join(found, ["cache_key", "entry_us"], "left")
    return out.withColumn("to", F.when(F.col("passes"), F.col("after.first")).otherwise(F.col("_to"))).drop("_to")


def _first_ends(steps: DataFrame) -> DataFrame:
    """(cache_key, chunk, valid_until_us): the end time with which every chunk but a key's first starts."""
    spark = steps.sparkSession
    links = store(spark, _links(steps), "links")
    jumps = store(spark, links.where("to is not null").select("cache_key", "entry_us", "to"), "jumps")
    levels = []
    while not jumps.isEmpty():
        levels.append(jumps)
        onward = jumps.select("cache_key", F.col("entry_us").alias("to"), F.col("to").alias("_to"))
        jumps = store(spark, jumps.join(onward, ["cache_key", "to"]).select("cache_key", "entry_us", F.col("_to").alias("to")), "jumps")
    reached = links.groupBy("cache_key").agg(F.min("entry_us").alias("entry_us"))
    for level in reversed(levels):  # who is reached in steps of 2^k, from the longest to single ones
        both = F.when(F.col("to").isNull(), F.array("entry_us")).otherwise(F.array("entry_us", "to"))
        reached = reached.join(level, ["cache_key", "entry_us"], "left").select("cache_key", F.explode(both).alias("entry_us"))
    on_path = links.join(reached, ["cache_key", "entry_us"], "left_semi")
    behind = F.when(F.col("passes"), F.array("next", "after")).otherwise(F.array("next"))
    return on_path.select("cache_key", "exit_us", F.explode(behind).alias("c")).where("c is not null").select(
        "cache_key", F.col("c.chunk").alias("chunk"), F.col("exit_us").alias("valid_until_us"))


def store_times(requests: DataFrame, seconds: str, ttl_seconds: Column) -> DataFrame:
    """(cache_key, stored_us): when each key's answer was stored."""
    times = requests.select(
        "cache_key", F.round(F.col(seconds) * 1e6).cast("bigint").alias("us"),
        (ttl_seconds * 1e6).cast("bigint").alias("ttl_us"))
    times = times.withColumn("chunk", F.floor(F.col("us") / (F.col("ttl_us") * CHUNK_TTLS)))
    # the join below asks for this; said here, both readers of `placed` share one shuffle
    times = times.where(F.col("cache_key").isNotNull() & F.col("chunk").isNotNull())
    placed = times.repartition("cache_key", "chunk").distinct()  # equal times count once; no further shuffle
    steps = placed.sortWithinPartitions("cache_key", "chunk", "us").mapInPandas(
        _summarise, "cache_key string, chunk bigint, entry_us bigint, exit_us bigint")
    starts = _first_ends(store(requests.sparkSession, steps, "steps"))
    return (
        placed.join(starts.hint("shuffle_merge"), ["cache_key", "chunk"], "left").na.fill(NEVER, ["valid_until_us"])
        .sortWithinPartitions("cache_key", "chunk", "us")
        .mapInPandas(_replay, "cache_key string, stored_us bigint")
    )


def hit_or_miss(requests: DataFrame, seconds: str, ttl_seconds: Column, tie: str) -> DataFrame:
    """Adds `cache`. Of several requests at one store time, the lowest `tie` is the miss. Without a key, a time or a
    time-to-live a request is neither: its `cache` is null."""
    stores = store_times(requests, seconds, ttl_seconds).withColumn("_store", F.lit(True))
    same_time = Window.partitionBy("cache_key", "stored_us").orderBy(tie)
    return (
        requests.withColumn("stored_us", F.round(F.col(seconds) * 1e6).cast("bigint"))
        .withColumn("_usable", F.col("cache_key").isNotNull() & F.col("stored_us").isNotNull() & ttl_seconds.isNotNull())
        .join(stores, ["cache_key", "stored_us"], "left")
        .withColumn("_first", F.row_number().over(same_time) == 1)
        .withColumn("cache", F.when(F.col("_usable"), F.when(F.col("_store") & F.col("_first"), "MISS").otherwise("HIT")))
        .drop("stored_us", "_store", "_first", "_usable")
    )
