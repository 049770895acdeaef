"""Ranked lexical search over bit-sliced Bloom signatures, exact at the end.

1. Index: documents with about as many distinct terms share a block. For each
   of the steps 1, 2, 3, 5, 9, ... a block has a Bloom signature of the terms that a document
   holds at least that often, stored by bit: a slice is a bitmap over the
   block's documents. The `and` of a term's slices shows every document that holds
   the term that often, and by chance a few more. A block also has its
   terms with the number of documents that hold them.
2. Upper bounds: a term found at a step but not at the next occurs at most as often as the
   next step less one. Weighted sums of the slices of an item's terms, times what a step can add to
   a document's score, bound the score from above.
3. Several times as many documents as are wanted, those with the highest bounds, are scored exactly. The score that
   the last wanted one of them reaches is a floor: every document whose bound is at least that is scored
   exactly from its whole text, so nothing but documents that provably rank lower is left out.

Score of a document: over the item's distinct terms, w * (10^9 tf div (1000 tf + 8 m)), with
w = floor(1000 ln((2N + 2) / (2 df + 1))) and m = 10 + (90 n N) div L.

Results: a null or empty text has no terms; it isn't counted and never found. Rows
with a null doc_id count in the statistics but can't be named and are not
ranked. Rows that share a doc_id are documents of their own. Rows that share an item_id are
one item with the terms of all; rows with a null item_id are no item. Without documents or
items there are no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonetally.llm.meeting import each_bin, meet, one_bin
from zonetally.llm.text import WordHashes, forget, mix, only, released, signed, texts_only
from zonetally.session import small, store

#: ASCII letters and digits and all bytes of other characters belong to terms; A-Z count as a-z.
_TERM_BYTES = bytes(k if k > 127 else ord(chr(k).lower()) if chr(k).isalnum() else 32 for k in range(256))
#: Bits of a document's signature per term of the block's largest document, and slices a term has.
BITS, HASHES = 24, 4
#: A block is closed at so many documents, or so many terms of documents in all.
BLOCK_DOCS, BLOCK_TERMS = 512, 100_000
#: Bytes of signatures in a bin, about.
BIN_BYTES = 8_000_000
#: Times the wanted documents that are scored for the floor: the highest bounds have terms that aren't there.
PROMISING = 8
#: Items whose bounds are computed together.
ITEMS_AT_ONCE = 64
_SCALE = 1_000_000_000


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def steps(top: int) -> list[int]:
    """1, 2, 3, 5, 9, 17, ... up to `top`."""
    out = [1]
    while (k := 2 * out[-1] - (len(out) > 1)) <= top:
        out.append(k)
    return out


def slices_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """The numbers of each term's slices."""
    with np.errstate(over="ignore"):
        each = [mix(hashes + np.uint64(0x9E3779B97F4A7C15) * np.uint64(k + 1)) for k in range(HASHES)]
    return (np.stack(each, axis=1) % np.uint64(width)).astype(np.int64)


def saturation(tf: int | np.ndarray, m: np.ndarray) -> np.ndarray:
    return (_SCALE * tf) // (1000 * tf + 8 * m)


INDEX = """block long, n_docs long, n_terms long, doc_ids array<long>, lengths array<long>, top long,
    signatures array<struct<step: long, width: long, slices: binary>>, terms array<binary>, dfs array<long>"""


class _Block:
    """Documents being put together."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.hashes: list[np.ndarray] = []
        self.tfs: list[np.ndarray] = []
        self.df: Counter = Counter()
        self.size = 0

    def add(self, key: int | None, n: int, hashes: np.ndarray, tf: Counter) -> None:
        self.ids.append(key)
        self.lengths.append(n)
        self.hashes.append(hashes)
        self.tfs.append(np.fromiter(tf.values(), np.int64, len(tf)))
        self.df.update(tf.keys())
        self.size += len(tf)

    @property
    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or self.size >= BLOCK_TERMS

    def row(self, number: int) -> pa.RecordBatch:
        hashes, tfs = np.concatenate(self.hashes), np.concatenate(self.tfs)
        doc = np.repeat(np.arange(len(self.ids)), [len(h) for h in self.hashes])
        top, signatures = int(tfs.max()), []
        for step in steps(top):
            here = tfs >= step
            most = int(np.bincount(doc[here]).max())
            width = BITS * most
            bits = np.zeros((width, len(self.ids)), bool)
            for slices in slices_of(hashes[here], width).T:
                bits[slices, doc[here]] = True
            signatures.append({"step": step, "width": width, "slices": np.packbits(bits, axis=1).tobytes()})
        values = (number, len(self.ids), sum(self.lengths), self.ids, self.lengths, top, signatures, list(self.df), list(self.df.values()))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(),
                 pa.list_(pa.struct([("step", pa.int64()), ("width", pa.int64()), ("slices", pa.binary())])), pa.list_(pa.binary()), pa.list_(pa.int64()))
        names = "block n_docs n_terms doc_ids lengths top signatures terms dfs".split()
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)


def index(docs: DataFrame) -> DataFrame:
    """The blocks of the documents that have terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        hashes, number = WordHashes(), TaskContext.get().partitionId() << 32
        open_blocks: dict[int, _Block] = {}
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = terms(text)
                if found:
                    tf = Counter(found)
                    kind = len(tf).bit_length()
                    block = open_blocks.setdefault(kind, _Block())
                    block.add(key, len(found), hashes.of(list(tf)), tf)
                    if block.full:
                        number += 1
                        yield open_blocks.pop(kind).row(number)
        for block in open_blocks.values():
            number += 1
            yield block.row(number)

    return texts_only(docs).mapInArrow(released(run), INDEX)


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, hash) of the distinct terms of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = list(set(terms(text)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(found), pa.int64()), pa.array(found, pa.binary()), pa.array(signed(hashes.of(found)))], ["item_id", "term", "hash"])

    return texts_only(items.where("item_id is not null"), "item_id").mapInArrow(run, "item_id long, term binary, hash long").distinct()


def weighted(wanted: DataFrame, blocks: DataFrame, n_docs: int) -> DataFrame:
    """(item_id, terms, hashes, weights) of every item; terms that no document holds are left out."""
    asked = small(store(wanted.sparkSession, wanted.select("term").distinct(), "terms"))
    each = blocks.select(F.explode(F.arrays_zip("terms", "dfs")).alias("of")).select(F.col("of.terms").alias("term"), F.col("of.dfs").alias("df"))
    df = each.join(asked, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0 * n_docs) + 2) / (2 * F.col("df").cast("double") + 1))).cast("long")
    rows = wanted.join(df, "term").withColumn("weight", weight).groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("term", "hash", "weight"))).alias("of"))
    return rows.select("item_id", *(F.col(f"of.{c}").alias(f"{c}s" if c != "hash" else "hashes") for c in ("term", "hash", "weight")))


class _Index:
    """The blocks of a bin, ready to be asked."""

    def __init__(self, rows: list[dict], n_docs: int, n_terms: int):
        self.blocks = []
        for row in rows:
            ids, lengths = row["doc_ids"], np.array(row["lengths"], np.int64)
            m = 10 + (90 * lengths * n_docs) // n_terms
            signs, last, gains = row["signatures"], np.zeros(len(ids), np.int64), []
            for sign, after in zip(signs, [s["step"] for s in signs[1:]] + [row["top"] + 1], strict=True):
                value = saturation(after - 1, m)  # found here and not at the next step: at most so often
                gains.append(value - last)
                last = value
            size = -(-len(ids) // 8)
            signs = [(s["width"], np.frombuffer(s["slices"], np.uint8).reshape(s["width"], size)) for s in signs]
            named = np.array([k is not None for k in ids])
            self.blocks.append((np.array([k or 0 for k in ids], np.int64), named, gains, signs))

    def bounds(self, weights: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(doc_ids, upper bounds as items x documents) of every block. weights: items x terms."""
        for ids, named, gains, signs in self.blocks:
            total = np.zeros((len(weights), len(ids)))
            there, at = None, np.arange(len(hashes))
            for gain, (width, slices) in zip(gains, signs, strict=True):
                own = np.bitwise_and.reduce(slices[slices_of(hashes[at], width)], axis=1)
                there = own if there is None else there & own
                some = there.any(axis=1)
                at, there = at[some], there[some]
                if not len(at):
                    break
                found = np.unpackbits(there, axis=1, count=len(ids)).astype(np.float64)
                total += (weights[:, at] @ found) * gain
            yield ids[named], total[:, named].astype(np.int64)


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[list[dict], np.ndarray, np.ndarray]]:
    """Some items at a time, with the weights of all their terms as a matrix and the terms' hashes."""
    for start in range(0, batch.num_rows, ITEMS_AT_ONCE):
        rows = batch.slice(start, ITEMS_AT_ONCE).to_pylist()
        hashes = np.unique(np.array([h for r in rows for h in r["hashes"]], np.int64))
        weights = np.zeros((len(rows), len(hashes)))
        for k, row in enumerate(rows):
            # two terms with one hash are in the same slices: their weights add up
            np.add.at(weights[k], np.searchsorted(hashes, np.array(row["hashes"], np.int64)), row["weights"])
        yield rows, weights, hashes.view(np.uint64)


def _pairs(items: list, ids: list, bounds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in (items, ids, bounds)], ["item_id", "doc_id", "bound"])


def _most_promising(most: int):
    def run(held: _Index, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for rows, weights, hashes in _batches(batch):
            ids, bounds = (np.concatenate(x, axis=-1) for x in zip(*held.bounds(weights, hashes), strict=True))
            items, docs, values = [], [], []
            for row, own in zip(rows, bounds, strict=True):
                at = np.argpartition(own, -most)[-most:] if len(own) > most else np.arange(len(own))
                at = at[own[at] > 0]
                items.append(np.full(len(at), row["item_id"]))
                docs.append(ids[at])
                values.append(own[at])
            yield _pairs(items, docs, values)

    return run


def _not_excluded(held: _Index, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for rows, weights, hashes in _batches(batch):
        floor = np.array([max(1, row["floor"]) for row in rows])[:, None]
        for ids, bounds in held.bounds(weights, hashes):
            k, at = np.nonzero(bounds >= floor)
            yield _pairs([np.array([r["item_id"] for r in rows], np.int64)[k]], [ids[at]], [bounds[k, at]])


def exact_scores(pairs: DataFrame, docs: DataFrame, items: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """(item_id, doc_id, score) of the pairs, a stored table, from the whole texts; rows that share a doc_id score each."""
    held = only(texts_only(docs), pairs).select(F.col("doc_id").alias("bin"), "text")
    asked = pairs.select("item_id", "doc_id").distinct().join(items.select("item_id", "terms", "weights"), "item_id")

    def keep(rows: list[dict]) -> list[tuple[Counter, int]]:
        found = [terms(r["text"]) for r in rows]
        return [(Counter(f), 10 + (90 * len(f) * n_docs) // n_terms) for f in found]

    def run(held: list[tuple[Counter, int]], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list, list] = ([], [], [])
        for row in batch.to_pylist():
            for tf, m in held:
                score = sum(w * (_SCALE * n // (1000 * n + 8 * m)) for term, w in zip(row["terms"], row["weights"], strict=True) if (n := tf.get(term)))
                for column, value in zip(out, (row["item_id"], row["doc_id"], score), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["item_id", "doc_id", "score"])

    return meet(held, asked.withColumn("bin", F.col("doc_id")), keep, run, "item_id long, doc_id long, score long")


def _place(score: str) -> Column:
    return F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc(score), "doc_id"))


def search(docs: DataFrame, items: DataFrame, most: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: each item's `most` documents with the highest scores above 0, equal ones by doc_id."""
    spark = docs.sparkSession
    blocks = store(spark, index(docs), "index")
    sizes = F.aggregate("signatures", F.lit(0).cast("long"), lambda total, s: total + F.length(s["slices"]))
    seen = blocks.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms"), F.sum(sizes).alias("bytes")).first()
    n_docs, n_terms = seen.docs or 0, seen.terms or 0
    wanted = store(spark, weighted(store(spark, item_terms(items), "item-terms"), blocks, n_docs), "items")

    bins = max(1, -(-(seen.bytes or 0) // BIN_BYTES))
    held = one_bin(blocks.select("block", "doc_ids", "lengths", "top", "signatures"), bins, "block")

    def keep(rows: list[dict]) -> _Index:
        return _Index(rows, n_docs, n_terms)

    asked = wanted.select("item_id", "hashes", "weights")
    schema = "item_id long, doc_id long, bound long"
    promising = meet(held, each_bin(asked, bins), keep, _most_promising(PROMISING * most), schema)
    promising = store(spark, promising.withColumn("rank", _place("bound")).where(F.col("rank") <= PROMISING * most), "promising")
    first = exact_scores(promising, docs, wanted, n_docs, n_terms).withColumn("rank", _place("score"))
    floor = first.where(F.col("rank") == most).select("item_id", F.col("score").alias("floor"))

    asked = asked.join(floor, "item_id", "left").withColumn("floor", F.coalesce("floor", F.lit(1)))
    pairs = store(spark, meet(held, each_bin(asked, bins), keep, _not_excluded, schema), "candidates")
    scored = exact_scores(pairs, docs, wanted, n_docs, n_terms).where("score > 0")
    return scored.withColumn("rank", _place("score")).where(F.col("rank") <= most).select("item_id", "rank", "doc_id", "score")
