"""Stored pieces that can be put together: panes of windowed KPIs, sketches of distinct keys.

A pane holds what the windows over it need: counts, and a KLL sketch of its latencies. A row of the input is aggregated
once, into its pane; windows of any length merge panes. Sketches of distinct keys (HLL) work alike: one per day and
run, say, and any set of days or runs merges them without the requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonetally.functions import columns as C

#: Values a quantile sketch keeps at its widest. Up to so many values percentiles are exact; beyond, ranks are off by less than 0.5 %.
QUANTILE_SIZE = 800
#: Two to this power are the registers of a sketch of distinct keys; 14 gives a standard error of 0.8 %.
DISTINCT_SIZE = 14


def quantile_sketch(value: str | Column) -> Column:
    """Sketch of a column's values. Nulls and NaN are left out, so an empty sketch is possible."""
    return F.kll_sketch_agg_double(value, F.lit(QUANTILE_SIZE))


def merged_quantiles(sketch: str | Column) -> Column:
    return F.kll_merge_agg_double(sketch, F.lit(QUANTILE_SIZE))


def quantile(sketch: str, share: float) -> Column:
    """Smallest value that at least this share of the values doesn't exceed, by the sketch; null if it is empty."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(share))))


def window_panes(records: DataFrame, time: str = "event_time", seconds: int = 30) -> DataFrame:
    """One row per pane of the time axis that has records: its start, its counts and a sketch of its latencies.

    Works on a table and on a stream with a watermark. Records without a time are in no pane.
    """
    return (
        records.groupBy(F.window(time, f"{int(seconds)} seconds").alias("pane"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("cache") == "HIT").alias("n_hits"),
            F.count_if(F.col("retry_count") > 0).alias("n_retried"),
            quantile_sketch("latency_ms").alias("latencies"),
        )
        .select(F.col("pane.start").alias("pane_start"), "n", "n_hits", "n_retried", "latencies")
    )


def windows_of_panes(panes: DataFrame, pane_seconds: int = 30, length: int = 60, slide: int = 30) -> DataFrame:
    """KPIs of sliding windows (seconds) with the columns of `window_kpis`, out of stored panes.

    Only panes are copied into the windows they belong to, so the work depends on the panes and not on the events.
    Length and slide must be multiples of the panes, else a window would cut one.
    """
    if pane_seconds <= 0 or slide <= 0 or length < slide or length % pane_seconds or slide % pane_seconds:
        raise ValueError(f"windows of {length} s every {slide} s can't be put together from panes of {pane_seconds} s")
    merged = panes.groupBy(F.window("pane_start", f"{int(length)} seconds", f"{int(slide)} seconds").alias("window")).agg(
        F.sum("n").alias("events_in_window"), F.sum("n_hits").alias("n_hits"), F.sum("n_retried").alias("n_retried"),
        merged_quantiles("latencies").alias("latencies"))
    return merged.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "events_in_window",
        quantile("latencies", 0.5).alias("p50_ms"), quantile("latencies", 0.95).alias("p95_ms"),
        C.ratio(F.col("n_hits"), F.col("events_in_window")).alias("hit_rate"),
        C.ratio(F.col("n_retried"), F.col("events_in_window")).alias("retried_share"))


def distinct_sketches(rows: DataFrame, by: list[str | Column], key: str = "cache_key") -> DataFrame:
    """One sketch of the distinct keys per group, to be stored. Rows without a key count in `n` only."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(key, F.lit(DISTINCT_SIZE)).alias("keys"), F.count(F.lit(1)).alias("n"))


def distinct_of(sketches: DataFrame, by: list[str | Column]) -> DataFrame:
    """About how many distinct keys each group of stored sketches holds together; filter the sketches to ask about a set of them."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("n_keys"), F.sum("n").alias("n"))
