"""Mixing sources to target weights by Sainte-Laguë apportionment of blocks of equal size.

1. Targets: each source gets a share of the mix by its weight, but no more than
   `most` times its size; what is over is shared anew by weight, until nobody is above.
2. Apportionment: the mix consists of blocks of equally many words. The blocks of shards 1 to j
   together go to the sources with the highest quotients target / (2k + 1), k being what a
   source has; equal quotients by order of the sources. As this way of seating is monotone, the
   differences from shard to shard are the integer quotas of each shard.
3. Selection: a source's documents stand in an order that is seeded by id and text, and
   are cut into blocks at every `block` words. A seeded permutation puts the blocks in turn;
   a source takes as many as its quotas say, all of them once before any a second time.

Sums over documents run in two levels: inside chunks of the seeded order, which
are equally full whatever the source, then over one row per chunk.

Results: a null text has size 0, and 0 words of it are taken. A null source is a source of its own, the last
one. A null doc_id is a document like any other. Rows with the same id, source and text
stand side by side and may be taken differently. An empty table gives no rows.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonetally.session import store

#: Words of a block, and shards of the mix.
BLOCK, SHARDS = 64, 16
#: Documents of a chunk, about.
CHUNK_DOCS = 5_000
_WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size (words), turn (seeded; 32 hexadecimal digits)."""
    text = F.coalesce("text", F.lit(""))
    # words = white runs in the text with its outer white removed, and one
    bare = F.regexp_replace(text, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    size = F.when(bare == "", 0).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("long")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    return docs.select("doc_id", "source", size.alias("size"), F.md5(key.cast("binary")).alias("turn"))


def with_starts(rows: DataFrame, n: int) -> DataFrame:
    """The rows with `start`: words of the same source before them in the seeded order."""
    chunks = min(1 << 20, 1 << max(0, (n // CHUNK_DOCS).bit_length()))
    chunk = (F.conv(F.substring("turn", 1, 5), 16, 10).cast("long") * chunks / (1 << 20)).cast("long")
    rows = rows.withColumn("chunk", chunk)
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("source", "chunk").agg(F.sum("size").alias("sum")).select(
        F.col("source").alias("of"), F.col("chunk").alias("in"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("carry"))
    inside = Window.partitionBy("source", "chunk").orderBy("turn", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    both = rows.join(carried, F.col("source").eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("in")))
    return both.withColumn("start", F.col("carry") + F.coalesce(F.sum("size").over(inside), F.lit(0))).drop("chunk", "of", "in", "carry")


def ranked_sources(rows: DataFrame) -> DataFrame:
    """source, source_size, nth (by code point from 0, null last). One row per source goes through one task."""
    found = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    return found.withColumn("nth", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)


def targets(spark: SparkSession, sources: DataFrame, share: float, most: int) -> DataFrame:
    """sources (source, source_size, weight, ...) with `target`: filled up by weight to `share` of all sizes, none above `most` times its size."""
    cap = most * F.col("source_size")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, capped = None, -1
    while True:  # the level only rises, so more sources are capped each time
        full = F.lit(False) if level is None else F.col("weight") * level >= cap
        seen = sources.agg(F.count(F.when(full, 1)).alias("n"), F.sum(F.when(full, cap)).alias("capped"), F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        if seen.n == capped or not seen.weight:
            break
        capped, level = seen.n, (share * total - (seen.capped or 0)) / seen.weight
    target = cap.cast("double") if level is None else F.when(full, cap.cast("double")).otherwise(F.col("weight") * F.lit(float(level)))
    return sources.withColumn("target", target)


def quotas(spark: SparkSession, sources: DataFrame, block: int, shards: int, most: int) -> DataFrame:
    """(nth, shard, upto): blocks of the source in shards 0 to `shard` together.

    Seats by a divisor come first; what that gives too few or too many is then settled quotient by quotient.
    No source gets over `most` times its blocks.
    """
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    house = round(total / block)
    seats = F.least(F.floor(F.col("target") / block * F.col("house") / house + 0.5), F.col("most_blocks")) if house else F.lit(0)
    rows = (sources.select("nth", "target", (most * F.ceil(F.col("source_size") / block)).alias("most_blocks"))
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
            .withColumn("house", F.floor(F.lit(house) * (F.col("shard") + 1) / shards))
            .withColumn("seats", seats.cast("long")))
    while True:
        rows = store(spark, rows, "seats")
        of = rows.groupBy("shard").agg(F.max("house").alias("h"), F.sum("seats").alias("given"), F.count("*").alias("n"),
                                       F.sum(F.when(F.col("seats") < F.col("most_blocks"), F.col("target"))).alias("open"))
        open_ = of.withColumn("missing", F.col("h") - F.col("given")).where("missing <> 0 and (missing < 0 or open > 0)").drop("h", "given")
        if open_.isEmpty():
            return rows.select("nth", "shard", F.col("seats").alias("upto"))
        near = rows.join(open_, "shard")
        # a source can gain or lose no more than its share of (missing + sources), and one
        reach = F.least(F.abs("missing"), F.ceil((F.abs("missing") + F.col("n")) * F.col("target") / F.coalesce("open", F.lit(1.0))) + 1)
        more = F.when(F.col("missing") > 0, F.least(reach, F.col("most_blocks") - F.col("seats"))).otherwise(F.least(reach, F.col("seats")))
        each = near.withColumn("more", more.cast("long")).where("more > 0").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("more"))))
        gain = F.col("missing") > 0
        quotient = F.col("target") / (2 * F.when(gain, F.col("seats") + F.col("k") - 1).otherwise(F.col("seats") - F.col("k")) + 1)
        order = Window.partitionBy("shard").orderBy(F.when(gain, -quotient).otherwise(quotient), F.when(gain, F.col("nth")).otherwise(-F.col("nth")))
        moved = (each.withColumn("place", F.row_number().over(order)).where(F.col("place") <= F.abs("missing"))
                 .groupBy("nth", "shard").agg(F.sum(F.signum("missing")).cast("long").alias("change")))
        rows = rows.join(moved, ["nth", "shard"], "left").withColumn("seats", F.col("seats") + F.coalesce("change", F.lit(0))).drop("change")


def stride(n: int, seed: int) -> tuple[int, int]:
    """(a, b) for the permutation x -> (a x + b) mod n."""
    a = max(1, int(n * 0.6180339887498949))
    while gcd(a, n) != 1:
        a += 1
    return a, (seed * 7919) % n if n else 0


_stride = F.udf(lambda n, seed: stride(n, seed), T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))


def mix(docs: DataFrame, weights: Column, share: float = 1.5, most: int = 2, block: int = BLOCK, shards: int = SHARDS, seed: int = 1) -> DataFrame:
    """doc_id, source, size, source_size, target, pieces.

    weights: a source's weight, from its columns `source`, `source_size` and `nth`.
    pieces: (start, length, copies, shards) of every stretch of the document's words that lies in one block, `shards` having the
    shard of each copy; stretches that aren't taken are left out.
    """
    spark = docs.sparkSession
    rows = store(spark, sizes(docs, seed), "sizes")
    sources = targets(spark, store(spark, ranked_sources(rows).withColumn("weight", weights), "sources"), share, most)
    sources = store(spark, sources, "targets")
    upto = quotas(spark, sources, block, shards, most)
    ends = upto.groupBy("nth").agg(F.transform(F.sort_array(F.collect_list(F.struct("shard", "upto"))), lambda x: x["upto"]).alias("ends"))
    blocks = F.ceil(F.col("source_size") / block)
    dim = sources.join(ends, "nth").withColumn("n_blocks", blocks).withColumn("stride", _stride("n_blocks", F.lit(seed)))
    dim = dim.select(F.col("source").alias("of"), "source_size", "target", "ends", "n_blocks", "stride")
    placed = with_starts(rows, rows.count()).join(_bounded(dim), F.col("source").eqNullSafe(F.col("of"))).drop("of")

    end = F.col("start") + F.col("size")

    def piece(b: Column) -> Column:
        # decimals hold the product of two long numbers
        turn = ((F.col("stride.a").cast("decimal(19,0)") * b.cast("decimal(18,0)") + F.col("stride.b")) % F.col("n_blocks")).cast("long")
        first, last = F.greatest(b * block, F.col("start")), F.least((b + 1) * block, end)
        places = F.filter(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda k: turn + k * F.col("n_blocks")), lambda x: x < F.element_at("ends", -1))
        shard = F.transform(places, lambda x: F.size(F.filter("ends", lambda e: e <= x)))
        return F.struct((first - F.col("start")).alias("start"), (last - first).alias("length"), F.size(places).alias("copies"), shard.alias("shards"))

    some = F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))
    pieces = F.when(F.col("size") > 0, F.filter(F.transform(some, piece), lambda p: p["copies"] > 0))
    return placed.select("doc_id", "source", "size", "source_size", "target", pieces.alias("pieces"))


#: Sources up to which their rows are broadcast.
MOST_SOURCES = 10_000


def _bounded(dim: DataFrame) -> DataFrame:
    dim = store(dim.sparkSession, dim, "sources")
    return F.broadcast(dim) if dim.count() <= MOST_SOURCES else dim


def taken(pieces: Column | str = "pieces") -> Column:
    """Words that the mix takes of a document, repeats counted."""
    return F.coalesce(F.aggregate(pieces, F.lit(0).cast("long"), lambda total, p: total + p["length"] * p["copies"]), F.lit(0).cast("long"))
