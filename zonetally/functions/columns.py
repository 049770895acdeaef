"""Column expressions: request keys, defaults, validation, rates, bins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonetally.functions import domains as D


def as_double(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def epoch_seconds(ts: str) -> Column:
    """Timestamp (with or without zone) to epoch seconds as double, microseconds kept."""
    return F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(1e6)


def event_time(ts: str = "ts") -> Column:
    """Epoch seconds to a timestamp usable as event time."""
    return F.col(ts).cast("timestamp")


def iso(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def normal_type(query_type: str = "query_type") -> Column:
    """Upper-case query type; null or empty becomes UNK."""
    return F.upper(F.coalesce(F.nullif(F.col(query_type), F.lit("")), F.lit("UNK")))


def ratio(num: Column, den: Column, digits: int | None = None) -> Column:
    """num / den, null where den is 0 or null."""
    r = F.when(den != 0, num.cast("double") / den)
    return r if digits is None else F.round(r, digits)


def share(condition: Column) -> Column:
    """Mean of a condition as a rate; a null condition counts as false."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def keeps(confidence: Column, minimum: Column) -> Column:
    """Confidence floor: minimum <= 0 keeps every row, else null and NaN fail."""
    return F.coalesce(
        F.when(minimum <= 0, F.lit(True)).otherwise(~F.isnan(confidence) & (confidence >= minimum)),
        F.lit(False),
    )


def bin_index(x: Column, bins: Column) -> Column:
    """Equal-width bin of x on [0, 1], last bin closed; null outside the range.

    The quotient is only a first guess: the neighbour wins where x lies beyond
    the bin's own edge, so that edges decide and not floating-point division.
    """
    n = bins.cast("int")
    step = F.lit(1.0) / n
    guess = F.least(F.floor(x * n).cast("int"), n - 1)
    index = (
        F.when(x < guess * step, guess - 1)
        .when((x >= (guess + 1) * step) & (guess != n - 1), guess + 1)
        .otherwise(guess)
    )
    return F.when(~F.isnan(x) & x.between(0.0, 1.0), index)


def request_key(query_type: Column, zone_a: Column, zone_b: Column, confidence: Column, bins: Column) -> Column:
    """Canonical text of a request. Two requests with one key have one answer."""
    conf = F.concat(F.lit(":conf="), F.format_string("%.2f", F.coalesce(confidence, F.lit(0.0))))

    def single(name: str) -> Column:
        return F.concat(F.lit(name + ":"), zone_a, conf)

    n_bins = F.coalesce(bins.cast("int"), F.lit(D.DEFAULT_BINS)).cast("string")
    kind = F.upper(query_type)
    return (
        F.when(kind == "Q1", single("count"))
        .when(kind == "Q2", single("area"))
        .when(kind == "Q3", single("density"))
        .when(kind == "Q4", F.concat(F.lit("compare:density:"), zone_a, F.lit(":"), zone_b, conf))
        .when(kind == "Q5", F.concat(F.lit("confidence_dist:"), zone_a, F.lit(":bins="), n_bins))
    )


def partition_key(zone_id: Column, zone_a: Column) -> Column:
    return F.coalesce(F.nullif(zone_id, F.lit("")), F.nullif(zone_a, F.lit("")), F.lit("Z0"))


def time_to_live(query_type: Column, ttl: dict[str, int] | None = None) -> Column:
    """Seconds an answer stays valid, by query type."""
    ttl = D.TTL_SECONDS if ttl is None else ttl
    table = F.create_map(*[F.lit(v) for pair in ttl.items() for v in pair])
    return F.coalesce(F.try_element_at(table, F.upper(query_type)), F.lit(D.DEFAULT_TTL_SECONDS))


def safe_label(label: Column) -> Column:
    return F.translate(label, "/ ", "__")


def window_doc_id(start: Column | str, end: Column | str) -> Column:
    """Document id of a window: its two bounds in a form safe for paths."""
    return F.concat_ws("_", *[F.translate(iso(c), ":+", "-p") for c in (start, end)])


def path_or(path: str, default) -> Column:
    """Nested field with a default for missing parts."""
    return F.coalesce(F.col(path), F.lit(default))


def zone_area_km2(lat_min: Column, lat_max: Column, lon_min: Column, lon_max: Column) -> Column:
    """Area of a latitude / longitude box on a locally flat Earth."""
    north_south = (lat_max - lat_min) * D.KM_PER_DEGREE
    east_west = (lon_max - lon_min) * D.KM_PER_DEGREE * F.cos(F.radians((lat_min + lat_max) / 2))
    return F.abs(north_south * east_west)


def first_reason(*checks: tuple[Column, str]) -> Column:
    """Text of the first failed check; null if all hold. A null check fails."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(why)) for ok, why in checks])


def request_reject_reason(query_type: Column, zone_a: Column, zone_b: Column, known_a: Column, known_b: Column,
                          confidence_min: Column, bins: Column) -> Column:
    """Why a request has no answer. A missing floor or number of bins stands for its default."""
    kind = F.upper(query_type)
    pair, histogram = kind == "Q4", kind == "Q5"
    floor, n = F.coalesce(confidence_min, F.lit(0.0)), F.coalesce(bins, F.lit(D.DEFAULT_BINS))
    return first_reason(
        (kind.isin(D.QUERY_TYPES), "unknown query type"),
        (zone_a.isNotNull(), "zone missing"),
        (~pair | zone_b.isNotNull(), "second zone missing"),
        (known_a, "unknown zone"),
        (~pair | known_b, "unknown second zone"),
        (histogram | ~F.isnan(floor), "floor is not a number"),
        (~histogram | (n >= 1), "bins must be positive"),
    )


def run_reject_reason(mode: Column, distribution: Column, rate: Column, duration: Column, count: Column,
                      fail_probability: Column) -> Column:
    return first_reason(
        (mode.rlike("^(sync|kafka)$"), "mode"),
        (distribution.rlike("^(zipf|uniform)$"), "distribution"),
        (rate > 0, "rate"),
        (duration.isNotNull() | count.isNotNull(), "duration or count"),
        (fail_probability.between(0.0, 1.0), "probability"),
    )


def uniform01(*parts: Column | str | int) -> Column:
    """Repeatable number in [0, 1) from the parts, the same in any engine with md5."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    text = F.concat_ws("/", *[c.cast("string") for c in cols])
    digits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    return digits / F.lit(float(1 << 52))


def pick(u: Column, items: list, weights: list[float]) -> Column:
    """Item of a short fixed list whose cumulative weight interval holds u."""
    total, cum = sum(weights), 0.0
    bounds = []
    for w in weights:
        cum += w
        bounds.append(cum / total)
    chosen = reduce(
        lambda acc, pair: F.when(u < pair[1], F.lit(pair[0])).otherwise(acc),
        list(zip(items, bounds))[-2::-1],
        F.lit(items[-1]),
    )
    return chosen


def zipf_weights(n: int, s: float) -> list[float]:
    return [rank ** -s for rank in range(1, n + 1)]
