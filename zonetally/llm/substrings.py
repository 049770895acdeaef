"""Substring deduplication with a count-min prefilter.

A window is `width` consecutive words. Every window has an anchor, the smallest
hash among the seeds (runs of SEED words) inside it; equal windows have equal
anchors, and about one seed in twenty is one, so an anchor's count bounds the
counts of its windows from above.

1. One pass over all texts gives each document's words, the hash of its word
   sequence and its distinct anchors. Texts with equal sequences form a class:
   all but the smallest doc_id lose everything (from `width` words on).
2. Each task counts the anchors of its documents in a count-min sketch of fixed
   size; sketches are merged by adding cells. Cells of two or more become a
   bitmap (`counters` / 4 bytes for both rows), the only thing broadcast.
3. Anchors that the sketch estimates at two or more are grouped exactly. A full
   sketch only lets more anchors through to this step; none is lost.
4. Windows with a repeated anchor are grouped exactly by their hash, which
   tells the smallest document of each; words of later ones go.

Windows are judged on the input. Rows with a null doc_id are neither searched
nor changed; null texts have no words; rows that share a doc_id don't remove
each other's words; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonetally.llm.repeats import covered
from zonetally.llm.text import WordHashes, chunks, long_ngram_hashes, map_texts, mix, ngram_hashes, signed, texts_only
from zonetally.session import store

WIDTH, SEED = 50, 8
#: Counters in each of the two rows of the sketch, a power of two.
COUNTERS = 1 << 26
_BLOCK_BITS = 19  # of a block of the bitmap


def window_anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """By window, its anchor."""
    seeds = ngram_hashes(hashes, SEED, seed=11)
    span, reach = width - SEED + 1, 1
    least = seeds
    while 2 * reach <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = span - reach
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def surveyed(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, sha256 of the words joined by a space, tag (64 bits of it), distinct anchors."""
    hashes = WordHashes()

    def run(keys: list, texts: list[bytes]) -> pa.RecordBatch:
        counts, digests, anchors = [], [], []
        for _, words in chunks(keys, texts):
            flat = hashes.of([w for some in words for w in some])
            for some, part in zip(words, np.split(flat, np.cumsum([len(w) for w in words])[:-1]), strict=True):
                counts.append(len(some))
                digests.append(hashlib.sha256(b" ".join(some)).digest())
                anchors.append(signed(np.unique(window_anchors(part, width))) if len(some) >= width else [])
        tags = [int.from_bytes(x[:8], "little", signed=True) for x in digests]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array([x.hex() for x in digests]), pa.array(tags, pa.int64()),
             pa.array(anchors, pa.list_(pa.int64()))], ["doc_id", "n_words", "sha256", "tag", "anchors"])

    return map_texts(texts_only(docs), run, "doc_id long, n_words long, sha256 string, tag long, anchors array<long>")


def _cells(anchors: np.ndarray, counters: int) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        found = [mix(anchors.view(np.uint64) * np.uint64(k)) & np.uint64(counters - 1) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
    return [x.astype(np.int64) + k * counters for k, x in enumerate(found)]


def sketch(anchored: DataFrame, counters: int) -> DataFrame:
    """(block, bits): the merged count-min sketch, a bit for each cell that counts two or more."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def rows() -> pa.RecordBatch:
            cells, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n)], ["cell", "n"])

        for batch in batches:
            held += _cells(batch["anchors"].flatten().to_numpy(), counters)
            if sum(map(len, held)) > 2_000_000:
                yield rows()
                held = []
        if held:
            yield rows()

    def bits(table: pa.Table) -> pa.Table:
        shown = np.zeros(1 << _BLOCK_BITS, np.uint8)
        shown[table["cell"].to_numpy() & (1 << _BLOCK_BITS) - 1] = 1
        block = int(table["cell"][0].as_py()) >> _BLOCK_BITS
        return pa.table({"block": pa.array([block], pa.int64()), "bits": pa.array([np.packbits(shown).tobytes()], pa.binary())})

    merged = anchored.select("anchors").mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).where("n > 1")
    return merged.select("cell", F.shiftright("cell", _BLOCK_BITS).alias("block")).groupBy("block").applyInArrow(bits, "block long, bits binary")


def estimated_repeated(anchored: DataFrame, counters: int) -> DataFrame:
    """(doc_id, tag, anchor) of the anchors whose estimate is two or more."""
    spark = anchored.sparkSession
    bitmap = np.zeros((2 * counters >> _BLOCK_BITS, 1 << _BLOCK_BITS - 3), np.uint8)
    for row in sketch(anchored, counters).toLocalIterator():
        bitmap[row.block] = np.frombuffer(row.bits, np.uint8)
    shared = spark.sparkContext.broadcast(bitmap.ravel())  # counters / 4 bytes, however large the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors = batch["anchors"].flatten().to_numpy()
            of = np.repeat(np.arange(batch.num_rows), batch["anchors"].value_lengths().to_numpy())
            one, two = (shared.value[c >> 3] >> (7 - (c & 7)).astype(np.uint8) & 1 for c in _cells(anchors, counters))
            keep = np.flatnonzero(one & two)
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(of[keep]), batch["tag"].take(of[keep]), pa.array(anchors[keep])], ["doc_id", "tag", "anchor"])

    return anchored.select("doc_id", "tag", "anchors").mapInArrow(run, "doc_id long, tag long, anchor long")


def _tag(words: list[bytes]) -> int:
    return int.from_bytes(hashlib.sha256(b" ".join(words)).digest()[:8], "little", signed=True)


def _of_that_text(rows: DataFrame) -> DataFrame:
    """The rows whose tag is that of their text, for tables in which a doc_id has several texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = [_tag(text.split()) == tag for text, tag in zip(batch["text"].to_pylist(), batch["tag"].to_pylist(), strict=True)]
            yield batch.filter(pa.array(same, pa.bool_()))

    return rows.select("doc_id", "tag", "text", "anchors").mapInArrow(run, "doc_id long, tag long, text binary, anchors array<long>")


def _suspect_windows(suspects: DataFrame, width: int) -> DataFrame:
    """(window, doc_id, tag, at) of the windows with one of the document's repeated anchors."""
    hashes = WordHashes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, tag, text, anchors in zip(*(batch[c].to_pylist() for c in ("doc_id", "tag", "text")), batch["anchors"], strict=True):
                words = hashes.of(text.split())
                repeated = np.sort(anchors.values.to_numpy().view(np.uint64))
                of = window_anchors(words, width)
                at = np.flatnonzero(repeated[np.minimum(np.searchsorted(repeated, of), len(repeated) - 1)] == of)
                found = signed(long_ngram_hashes(words, width)[at])
                columns = [pa.array(found), pa.array(np.full(len(at), doc)), pa.array(np.full(len(at), tag)), pa.array(at.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["window", "doc_id", "tag", "at"])

    return suspects.select("doc_id", "tag", "text", "anchors").mapInArrow(run, "window long, doc_id long, tag long, at int")


def _cut(rows: DataFrame, width: int) -> DataFrame:
    """doc_id, tag, n_removed, kept (the words left, joined by a space) of texts with removed windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for text, at in zip(batch["text"].to_pylist(), batch["at"], strict=True):
                words = text.split()
                starts = at.values.to_numpy()
                gone = covered(starts, np.full(len(starts), width), len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, x in zip(words, gone, strict=True) if not x).decode())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["tag"], pa.array(removed, pa.int64()), pa.array(kept)], ["doc_id", "tag", "n_removed", "kept"])

    return rows.select("doc_id", "tag", "text", "at").mapInArrow(run, "doc_id long, tag long, n_removed long, kept string")


def remove_repeats(docs: DataFrame, width: int = WIDTH, counters: int = COUNTERS) -> tuple[DataFrame, DataFrame]:
    """Two tables. All rows: doc_id, tag, n_words, sha256 (of the words as they were), whole (whether all words go).
    Texts that lose some words: doc_id, tag, n_removed, kept (the text left)."""
    spark = docs.sparkSession
    survey = store(spark, surveyed(docs, width), "survey")
    long = survey.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= width))
    classes = long.groupBy("sha256").agg(F.min("doc_id").alias("first_id"))
    rows = survey.drop("anchors").join(classes, "sha256", "left").withColumn("whole", F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False)))

    anchored = long.join(classes.select(F.col("first_id").alias("doc_id"), "sha256"), ["doc_id", "sha256"], "left_semi")
    anchored = store(spark, anchored.dropDuplicates(["doc_id", "tag"]).select("doc_id", "tag", "anchors"), "anchors")
    likely = store(spark, estimated_repeated(anchored, counters), "likely")
    repeated = likely.groupBy("anchor").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    of_docs = likely.join(repeated.select("anchor"), "anchor").groupBy("doc_id", "tag").agg(F.collect_list("anchor").alias("anchors"))

    suspects = _of_that_text(texts_only(docs).join(of_docs, "doc_id")).dropDuplicates(["doc_id", "tag"])
    suspects = store(spark, suspects, "suspects")
    windows = store(spark, _suspect_windows(suspects, width), "windows")
    first = windows.groupBy("window").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    gone = windows.join(first.select("window", "least"), "window").where("doc_id > least").groupBy("doc_id", "tag").agg(F.collect_list("at").alias("at"))
    return rows, _cut(suspects.join(gone, ["doc_id", "tag"]), width)
