"""Near-duplicates by SuperMinHash signatures, banding, verification on full sets and union-find.

1. A document is the set of its distinct word shingles. Texts with equal sets
   form a class; its smallest doc_id stands for it from there on.
2. SuperMinHash gives each set its signature: every element walks through a
   random permutation of the slots, its k-th step gives ranks of k to k + 1, so
   an element serves many slots with correlated, evenly spread ranks; the walk
   stops once no slot can still improve.
3. Representatives that agree on a band of the signature share a bucket.
4. In each bucket one member, the hub, is compared with the others on their full
   sets, and links join classes into components.
5. Representatives that still share a bucket with another component are
   compared exactly, without going through pairs of a bucket: their shingles
   are ordered from rare to frequent, and a link of 75 % is only possible where
   two sets meet early enough in that order (prefix and position filter). What
   many texts quote is frequent and comes last. Pairs inside a component can't
   change the result and are left out.
6. Union-find over the links of both steps gives the groups.

Results: a null or empty text has no shingle and links with nothing; rows with
a null doc_id link with nothing, get a null component_id and are kept; rows
that share a doc_id share its component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonetally.llm.components import components
from zonetally.llm.text import WordHashes, chunks, map_texts, mix, ngram_hashes, only, signed, texts_only
from zonetally.session import store

SHINGLE = 5
#: Bands and rows: sets that share 75 % of their elements miss each other in all bands once in 400,000 cases.
BANDS, ROWS = 48, 5
#: Links need this share of common elements, in percent.
PERCENT = 75
_LEVEL = np.uint64(44)  # bits of a rank within its step
#: Elements that walk at once; each holds a permutation of the slots meanwhile.
WALKERS = 1 << 16
#: Sets whose sizes differ by less than this factor share a length class.
_CLASS = 1.1


def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash of each set of 64-bit elements, as rows of m numbers: step << 44 | rank in the step. m is 256 at most.

    Elements walk in slices, and a set's signature is the minimum over its slices: memory doesn't grow with a set.
    """
    best = np.full((len(sets), m), np.iinfo(np.uint64).max, np.uint64)
    for some in _slices(sets):
        np.minimum.at(best, [i for i, _ in some], _walk([part for _, part in some], m))
    return best


def _slices(sets: list[np.ndarray]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Parts of the sets with their set's number, `WALKERS` elements at a time."""
    some, room = [], WALKERS
    for i, elements in enumerate(sets):
        while len(elements):
            some.append((i, elements[:room]))
            elements, room = elements[room:], room - len(some[-1][1])
            if not room:
                yield some
                some, room = [], WALKERS
    if some:
        yield some


def _walk(sets: list[np.ndarray], m: int) -> np.ndarray:
    sizes = np.array([len(s) for s in sets])
    elements, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    best = np.full(len(sets) * m, np.iinfo(np.uint64).max, np.uint64)
    order = np.tile(np.arange(m, dtype=np.uint8), (len(elements), 1))
    walking = np.arange(len(elements))
    for j in range(m):
        with np.errstate(over="ignore"):
            x = mix(elements[walking] + np.uint64(0x9E3779B97F4A7C15) * np.uint64(j + 1))
        k = j + ((x & np.uint64(0xFFFFF)) * np.uint64(m - j) >> np.uint64(20)).astype(np.int64)
        slot = order[walking, k]
        order[walking, k] = order[walking, j]
        np.minimum.at(best, of[walking] * m + slot, np.uint64(j) << _LEVEL | x >> np.uint64(20))
        unfinished = best.reshape(-1, m).max(axis=1) >> _LEVEL > np.uint64(j)
        walking = walking[unfinished[of[walking]]]
        if not len(walking):
            break
    return best.reshape(-1, m)


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of the whole sequence if it is shorter; none without words."""
    return np.unique(ngram_hashes(hashes, min(size, len(hashes)) or size))


def _sets(keys: list, texts: list[bytes], hashes: WordHashes, size: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    for some, words in chunks(keys, texts, lower=True):
        flat = hashes.of([w for each in words for w in each])
        cuts = np.cumsum([len(w) for w in words])
        yield some, [shingle_set(part, size) for part in np.split(flat, cuts[:-1])]


def sketches(docs: DataFrame, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, digest (of the set; null if empty), bands (hash of each band of the signature)."""
    hashes = WordHashes()

    def run(keys: list, texts: list[bytes]) -> pa.RecordBatch:
        counts, digests, values = [], [], []
        for _, sets in _sets(keys, texts, hashes, size):
            full = [s for s in sets if len(s)]
            if full:
                signature = signatures(full, bands * rows).reshape(len(full), bands, rows)
                band = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(full), 1))
                with np.errstate(over="ignore"):
                    for k in range(rows):
                        band = mix(band * np.uint64(0x9E3779B97F4A7C15) + signature[:, :, k])
                hashed = iter(signed(band))
            counts += map(len, sets)
            digests += [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            values += [next(hashed) if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(values, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "digest", "bands"])

    return map_texts(texts_only(docs), run, "doc_id long, n_shingles long, digest binary, bands array<long>")


def shingle_sets(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and its whole set: sorted 64-bit hashes, as bytes."""
    hashes = WordHashes()

    def run(keys: list, texts: list[bytes]) -> pa.RecordBatch:
        sets = [s.tobytes() for _, some in _sets(keys, texts, hashes, size) for s in some]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], ["doc_id", "shingles"])

    return map_texts(texts_only(docs), run, "doc_id long, shingles binary")


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, None
        for batch in batches:
            keep = []
            for a, one, two in zip(batch["a"].to_pylist(), batch["one"].to_pylist(), batch["two"].to_pylist(), strict=True):
                if a != held:
                    held, first = a, np.frombuffer(one, np.uint64)
                second = np.frombuffer(two, np.uint64)
                at = np.searchsorted(first, second)
                common = int(np.count_nonzero(first[np.minimum(at, len(first) - 1)] == second))
                keep.append(100 * common >= percent * (len(first) + len(second) - common))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep))

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose whole sets share `percent` of their union."""
    with_b = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("two")), "b")
    with_a = with_b.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("one")), "a")
    return with_a.select("a", "b", "one", "two").mapInArrow(_linked(percent), "a long, b long")


def _elements(sets: DataFrame) -> DataFrame:
    """(doc_id, root, n, shingle) of every element of the sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, root, raw in zip(batch["doc_id"].to_pylist(), batch["root"].to_pylist(), batch["shingles"].to_pylist(), strict=True):
                found = np.frombuffer(raw, np.int64)
                n = len(found)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, x)) for x in (doc, root, n)] + [pa.array(found)], ["doc_id", "root", "n", "shingle"])

    return sets.select("doc_id", "root", "shingles").mapInArrow(run, "doc_id long, root long, n long, shingle long")


def prefixes(sets: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Elements under which the smaller and the larger set of a pair can meet: (shingle, level, doc_id, root, n, place) each.

    For an overlap of `need` = ceil(percent / (100 + percent) * (n_a + n_b)), the first common element in any order
    must leave need - 1 elements behind it in both sets. The larger set of a pair thus meets in its first 25 % (at 75 percent), the
    smaller one in its first 14 %, and there each place bounds how large the other can be. `level` is the length class of the larger set;
    rows of the smaller one are repeated for the few classes that their place allows.
    """
    rows = _elements(sets)
    shared = rows.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    own = Window.partitionBy("doc_id")
    # elements of one set alone come first; they meet nothing and only take places
    place = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("df", "shingle"))
    placed = rows.join(shared, "shingle").withColumn("place", place).drop("df")

    def level(n: Column) -> Column:
        return F.floor(F.log(n) / F.lit(float(np.log(_CLASS))))

    largest = F.expr(f"({100 + percent} * (n - place + 1)) div {percent} - n")
    smaller = placed.where(largest >= F.col("n")).withColumn("level", F.explode(F.sequence(level(F.col("n")), level(largest))))
    larger = placed.where(F.expr(f"100 * (n - place + 1) >= {percent} * n")).withColumn("level", level(F.col("n")))
    return smaller, larger


def prefix_pairs(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) of sets with different roots that can share `percent` of their union; misses none that do."""
    small, large = (
        side.select("shingle", "level", *(F.col(c).alias(f"{c}_{name}") for c in ("doc_id", "root", "n", "place")))
        for name, side in zip(("a", "b"), prefixes(sets, percent), strict=True))
    met = small.join(large, ["shingle", "level"]).where(f"""(n_a < n_b or n_a = n_b and doc_id_a < doc_id_b) and root_a <> root_b
        and (100 + {percent}) * least(n_a - place_a + 1, n_b - place_b + 1) >= {percent} * (n_a + n_b)
        and 100 * n_a >= {percent} * n_b""")
    return met.select(F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b")).distinct()


def _sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Stored sets of the documents in `wanted`."""
    spark = docs.sparkSession
    return store(spark, shingle_sets(only(texts_only(docs), wanted), size), "shingles")


def group(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (whether the row stands for its component)."""
    spark = docs.sparkSession
    sketch = store(spark, sketches(docs, size, bands, rows), "sketches")
    classes = store(spark, sketch.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")

    banded = sketch.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    member = banded.select(F.explode("bands").alias("key"), "doc_id", "n_shingles")
    hubs = member.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("other")).where("hub < other")
    member = store(spark, member.join(hubs.select("key", "hub"), "key"), "buckets")

    pairs = store(spark, member.where("hub < doc_id").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct(), "pairs")
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    links = store(spark, verified(pairs, _sets_of(docs, wanted, size), percent), "links")
    first = components(links)

    labelled = member.join(first, member["doc_id"] == first["node"], "left").select("key", "doc_id", F.coalesce("root", "doc_id").alias("root"))
    crowded = labelled.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most")
    still = store(spark, labelled.join(crowded.select("key"), "key", "left_semi").select("doc_id", "root").distinct(), "open")
    sets = _sets_of(docs, still, size)
    more = store(spark, prefix_pairs(sets.join(still, "doc_id"), percent), "pairs")
    late = verified(more, sets, percent)
    roots = components(links.union(late))

    named = classes.join(roots, classes["rep"] == roots["node"], "left").select("digest", F.coalesce("root", "rep").alias("root"))
    out = sketch.join(named, "digest", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
