"""Benchmark decontamination: rare n-gram seeds join documents to items, Smith-Waterman scores the passages.

1. Every GRAM-word sequence of an item is a gram. One pass over the documents
   finds those they hold (a bitmap of fixed size passes over the others) and so
   in how many documents each gram is.
2. Rare grams are seeds by themselves: a join on them leads to their items. A
   common gram (in many documents, or in many items) is a seed only together
   with KEPT words: an alignment of the least score keeps at least that share of
   the item's words, so KEPT of the item's rarest words, if these are KEPT more
   than it may lose. A second pass looks for these words within reach of common
   grams; the join is on (gram, word). Grams that no document holds lead nowhere
   and push no other seed out.
3. The passage around the seeds is aligned with the item: Smith-Waterman over
   words, +2 for equal words, -1 for others and for gaps. The passage reaches as
   far as an alignment of the least score can. The score is the best alignment's
   sum as a share of the item's full score; copies with edits, insertions or
   omissions lower it gradually.

So every pair is reported whose best alignment reaches the least score and keeps
GRAM words in a row. Where edits leave no three words together (every third word
changed: 0.5, for items of some ten words up to 0.63), nothing leads to the item.
The rows of common seeds of an item are its common grams times half its words.

Words are runs of ASCII letters, digits and non-ASCII bytes, in lower case. Null and empty texts, on either side, match nothing; items shorter
than a gram are one gram; rows with a null doc_id or item_id are not reported; documents
or items that share an id are compared each and reported with the best score;
empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonetally.llm.text import CHUNK_WORDS, forget, mix, ngram_hashes, only, released, signed, texts_only
from zonetally.session import store

GRAM = 3
#: Pairs below this share of the item's full score are not reported.
LEAST_SCORE = 0.5
#: Documents up to which a gram is rare, and items up to which one that is in more than so many documents is.
RARE_DOCS, RARE_ITEMS = 1_000, 8
#: The item's rare words that a common gram needs around it.
KEPT = 2
#: Bits of a bitmap, a power of two. A full one lets more rows through to the join, which is exact.
BITS = 1 << 27
#: Numbers (8 bytes each) up to which the items' side of a join is broadcast; they are counted first.
MOST_NUMBERS = 1 << 21
#: Parts of a key in a join of larger sides.
SALTS = 16
#: Items of a document that travel with one copy of its text.
LISTED = 4096
#: Bytes of texts whose words are hashed together, unless one text alone has more.
CHUNK_BYTES = 1 << 19
#: Bytes beyond which a word is hashed by itself.
LONG_WORD = 64
MATCHES = "doc_id long, item_id long, score double, first_word long, end_word long"

_PLAIN = bytes(k + 32 if 65 <= k <= 90 else k if 97 <= k <= 122 or 48 <= k <= 57 or k >= 128 else 32 for k in range(256))


#: The bytes of a little-endian number that belong to a word with so many bytes left.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _lower(text: bytes) -> bytes:
    return text if text.isascii() else text.decode().lower().encode()


def plain_words(text: bytes) -> list[bytes]:
    return _lower(text).translate(_PLAIN).split()


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the `plain_words` of several texts, one after the other, and the number of each text's words.

    Eight bytes of all words are taken at a time; words have no zero bytes, so those
    of up to eight bytes never share a hash.
    """
    lower = [_lower(text) for text in texts]
    data = b" ".join([b"", *lower, bytes(8)]).translate(_PLAIN)  # begins and ends outside words
    inside = np.frombuffer(data, np.uint8) != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, size = edges[::2], edges[1::2] - edges[::2]
    hashes = np.empty(len(start), np.uint64)
    for k in range(0, len(start), CHUNK_WORDS):
        hashes[k:k + CHUNK_WORDS] = _hashes_at(data, start[k:k + CHUNK_WORDS], size[k:k + CHUNK_WORDS])
    ends = np.cumsum([len(text) + 1 for text in lower])
    return hashes, np.diff(np.searchsorted(start, ends), prepend=0)


def _hashes_at(data: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    hashes = mix(eight[start] & _FIRST_BYTES[np.minimum(size, 8)])
    for done in range(8, LONG_WORD, 8):
        more = np.flatnonzero((size > done) & (size <= LONG_WORD))
        if not len(more):
            break
        part = eight[start[more] + done] & _FIRST_BYTES[np.minimum(size[more] - done, 8)]
        with np.errstate(over="ignore"):
            hashes[more] = mix(hashes[more] * np.uint64(0x9E3779B97F4A7C15) + part)
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        hashes[k] = xxhash.xxh64_intdigest(data[start[k]:start[k] + size[k]])
    return hashes


def grams(words: np.ndarray, width: int = GRAM) -> np.ndarray:
    """Hash of every `width` words in a row; of all of them if there are fewer."""
    return ngram_hashes(words, min(width, max(1, len(words))), seed=13)


def reach(n: int, least: float) -> int:
    """Words around a seed that an alignment can touch: more between would cost more than the score may lack."""
    return n + int(2 * n * (1 - least)) + 1


def alignment(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local score and the part [start, end) of the passage that reaches it."""
    best, end = _best_end(item, passage)
    _, back = _best_end(item[::-1], passage[:end][::-1])
    return best, end - back, end


def _best_end(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    n = len(passage)
    at = np.arange(n + 1)
    row, best, end = np.zeros(n + 1, np.int64), 0, 0
    for word in item:
        fresh = np.maximum(row - 1, 0)
        fresh[1:] = np.maximum(fresh[1:], row[:-1] + np.where(passage == word, 2, -1))
        row = np.maximum.accumulate(fresh + at) - at  # gaps in the item, one after the other
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def _arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(released(run), schema)


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    flat = np.concatenate(parts) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(flat, kind))


def item_words(benchmark: DataFrame) -> DataFrame:
    """item (a number for the id and its text), item_id, n, words (hashes in order) of items with words."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words, sizes = word_hashes(batch["text"].to_pylist())
        lists = _lists(np.split(signed(words), np.cumsum(sizes)[:-1]), pa.int64())
        yield pa.RecordBatch.from_arrays([batch["item"], batch["item_id"], pa.array(sizes.astype(np.int32)), lists], ["item", "item_id", "n", "words"])

    known = texts_only(benchmark, "item_id").where("item_id is not null").distinct().withColumn("item", F.xxhash64("item_id", "text"))
    return _arrow(known.select("item", "item_id", "text"), run, "item long, item_id long, n int, words array<long>").where("n > 0")


def item_grams(items: DataFrame) -> DataFrame:
    """gram, item, n: every distinct gram of every item."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for item, n, words in zip(batch["item"].to_pylist(), batch["n"].to_pylist(), batch["words"], strict=True):
            found = np.unique(grams(words.values.to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(signed(found)), pa.array(np.full(len(found), item)), pa.array(np.full(len(found), n, np.int32))], ["gram", "item", "n"])

    return _arrow(items.select("item", "n", "words"), run, "gram long, item long, n int")


class Bitmap:
    """Which numbers may be in a column: BITS bits, however many rows there are."""

    def __init__(self, df: DataFrame, column: str):
        cell = F.col(column).bitwiseAND(F.lit(BITS - 1))
        bit = F.expr(f"shiftleft(1L, cast({column} & 63 as int))")
        rows = df.groupBy(F.shiftright(cell, 6).alias("at")).agg(F.bit_or(bit).alias("bits")).toArrow()
        bits = np.zeros(BITS // 64, np.uint64)
        bits[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
        self.shared = df.sparkSession.sparkContext.broadcast(bits)

    def has(self, codes: np.ndarray) -> np.ndarray:
        return (self.shared.value[(codes & np.uint64(BITS - 1)) >> np.uint64(6)] >> (codes & np.uint64(63)) & np.uint64(1)).astype(bool)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of the batch and the row of the first, cut so that a chunk has about CHUNK_BYTES."""
    first, texts, size = 0, [], 0
    for text in batch["text"].to_pylist():
        texts.append(text)
        size += len(text)
        if size >= CHUNK_BYTES:
            yield first, texts
            first, texts, size = first + len(texts), [], 0
    if texts:
        yield first, texts


def _found(docs: DataFrame, name: str, search: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """doc_id, tag, `name`, at (places): a row per text and distinct code. `search` has the words of several texts in a row
    and the number of each word's text; it tells codes and their places."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, texts in _chunks(batch):
            words, sizes = word_hashes(texts)
            of = np.repeat(np.arange(len(texts)), sizes)
            codes, places = search(words, of)
            if not len(codes):
                continue
            order = np.lexsort((places, codes, of[places]))
            codes, places = codes[order], places[order]
            text = of[places]
            new = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]) | (text[1:] != text[:-1])))
            row = pa.array(first + text[new])
            at = pa.array((places - (np.cumsum(sizes) - sizes)[text]).astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(codes)).astype(np.int32)), at)
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(row), batch["tag"].take(row), pa.array(signed(codes[new])), lists], ["doc_id", "tag", name, "at"])

    return _arrow(docs.select("doc_id", "tag", "text"), run, f"doc_id long, tag long, {name} long, at array<int>")


def _grams_within(words: np.ndarray, of: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of texts that follow each other, and where they start; none reaches into the next text."""
    at = np.flatnonzero(of[:len(of) - width + 1] == of[width - 1:])
    return ngram_hashes(words, width, seed=13)[at], at


def held_grams(docs: DataFrame, bitmap: Bitmap, widths: list[int]) -> DataFrame:
    """doc_id, tag, gram, at: the grams of items in each text (and some of the same bits)."""
    def search(words: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [(np.empty(0, np.uint64), np.empty(0, np.int64))]
        for width in widths:
            if len(words) >= width:
                code, at = _grams_within(words, of, width)
                hit = bitmap.has(code)
                found.append((code[hit], at[hit]))
        return tuple(map(np.concatenate, zip(*found, strict=True)))

    return _found(docs, "gram", search)


def _with_span(gram: np.ndarray, span: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(gram + np.uint64(span) * np.uint64(0x9E3779B97F4A7C15))


def _with_word(of: np.ndarray, word: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(of * np.uint64(0xC2B2AE3D27D4EB4F) + word)


def rare_words(items: DataFrame, least: float) -> DataFrame:
    """item, rare: the item's words in the fewest items, so many places that an alignment of the least score keeps KEPT of them."""
    each = items.select("item", "n", F.explode("words").alias("word"))
    known = each.groupBy("word").agg(F.count_distinct("item").alias("in_items"))
    places = met(each, known, "word", 2).groupBy("item", "n").agg(F.array_sort(F.collect_list(F.struct("in_items", "word"))).alias("w"))
    asked = F.col("n") - F.ceil(F.col("n") * F.lit(least)) + KEPT
    return places.select("item", F.slice("w.word", F.lit(1), F.least(asked, F.col("n")).cast("int")).alias("rare"))


def common_seeds(common: DataFrame, items: DataFrame, least: float) -> DataFrame:
    """key (of a common gram and one of the item's rarest words), span (bits of the reach), code (of gram and span), item, n, places (of the word)."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for gram, item, n, rare in zip(batch["gram"].to_numpy().view(np.uint64), batch["item"].to_pylist(), batch["n"].to_pylist(), batch["rare"], strict=True):
            span = reach(n, least).bit_length()
            code = _with_span(np.array([gram]), span)
            key, places = np.unique(_with_word(code, rare.values.to_numpy().view(np.uint64)), return_counts=True)
            full = [signed(key), np.full(len(key), span, np.int32), np.full(len(key), signed(code)[0]), np.full(len(key), item), np.full(len(key), n, np.int32), places.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in full], ["key", "span", "code", "item", "n", "places"])

    rows = common.select("gram", "item", "n").join(rare_words(items, least), "item").select("gram", "item", "n", "rare")
    return _arrow(rows, run, "key long, span int, code long, item long, n int, places int")


def near_common(docs: DataFrame, seeds: DataFrame, widths: list[int]) -> DataFrame:
    """doc_id, tag, key, at: common grams with one of their words within reach, in each text."""
    spans = sorted(r.span for r in seeds.select("span").distinct().collect())  # numbers of bits
    codes, keys = Bitmap(seeds.select("code"), "code"), Bitmap(seeds.select("key"), "key")

    def search(words: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [(np.empty(0, np.uint64), np.empty(0, np.int64))]
        for width in widths:
            if len(words) < width:
                continue
            gram, start = _grams_within(words, of, width)
            for span in spans:
                code = _with_span(gram, span)
                hit = codes.has(code)
                code, at = code[hit], start[hit]
                around = np.arange(-(1 << span), (1 << span) + 1)
                some = max(1, 1_000_000 // len(around))
                for k in range(0, len(at), some):
                    place = at[k:k + some, None] + around
                    inside = np.clip(place, 0, len(words) - 1)
                    key = _with_word(code[k:k + some, None], words[inside])
                    row, column = np.nonzero(keys.has(key) & (place == inside) & (of[inside] == of[at[k:k + some]][:, None]))
                    one = np.unique(np.stack([key[row, column], at[k:k + some][row].astype(np.uint64)]), axis=1)
                    found.append((one[0], one[1].astype(np.int64)))
        return tuple(map(np.concatenate, zip(*found, strict=True)))

    return _found(docs, "key", search)


def met(many: DataFrame, few: DataFrame, key: str, numbers: int | Column) -> DataFrame:
    """Join by key. `few` is broadcast if its rows of so many numbers are within MOST_NUMBERS; else hot keys are parted."""
    size = few.agg(F.sum(F.lit(numbers) if isinstance(numbers, int) else numbers)).first()[0] or 0
    if size <= MOST_NUMBERS:
        return many.join(F.broadcast(few), key)
    salted = many.withColumn("salt", (F.rand(1) * SALTS).cast("int"))
    return salted.join(few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [key, "salt"]).drop("salt")


def passages(docs: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """doc_id, item, start, passage: the words around the seeds of each pair (doc_id, tag, item, n, at)."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        docs_of, items, starts, cut, size = [], [], [], [], 0
        for doc, text, some in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "some")), strict=True):
            words = signed(word_hashes([text])[0])
            for one in some:
                far, at = reach(one["n"], least), np.unique(np.array(one["at"], np.int64))
                for part in np.split(at, np.flatnonzero(np.diff(at) > 2 * far) + 1) if len(at) > 1 else [at]:
                    start = max(0, int(part[0]) - far)
                    docs_of.append(doc)
                    items.append(one["item"])
                    starts.append(start)
                    cut.append(words[start:int(part[-1]) + far])
                    size += len(cut[-1])
                if size > 500_000:
                    yield _passages(docs_of, items, starts, cut)
                    docs_of, items, starts, cut, size = [], [], [], [], 0
        if items:
            yield _passages(docs_of, items, starts, cut)

    def _passages(docs_of: list, items: list, starts: list, cut: list) -> pa.RecordBatch:
        columns = [*(pa.array(c, pa.int64()) for c in (docs_of, items, starts)), _lists(cut, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "item", "start", "passage"])

    one = pairs.groupBy("doc_id", "tag", "item", "n").agg(F.flatten(F.collect_list("at")).alias("at"))
    parts = F.floor(F.count("*").over(Window.partitionBy("doc_id", "tag")) / LISTED).cast("int") + 1
    listed = one.withColumn("part", F.pmod("item", parts)).groupBy("doc_id", "tag", "part").agg(F.collect_list(F.struct("item", "n", "at")).alias("some"))
    listed = store(docs.sparkSession, listed, "seeded")
    texts = only(docs, listed).join(listed, ["doc_id", "tag"])
    return _arrow(texts.select("doc_id", "text", "some"), run, "doc_id long, item long, start long, passage array<long>")


def aligned(found: DataFrame, least: float) -> DataFrame:
    """The passages whose best alignment with the item reaches the least score."""
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for doc, item_id, start, passage, words in zip(*(batch[c].to_pylist() for c in ("doc_id", "item_id", "start")), batch["passage"], batch["words"], strict=True):
            item, of = words.values.to_numpy(), passage.values.to_numpy()
            full = 2 * len(item)
            if np.isin(item, of).sum() < least * len(item):
                continue
            score, end = _best_end(item, of)
            if score >= least * full:
                _, first, last = alignment(item, of[:end])
                out.append((doc, item_id, score / full, start + first, start + last))
        columns = list(zip(*out, strict=True)) or [[]] * 5
        types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "item_id", "score", "first_word", "end_word"])

    return _arrow(found.select("doc_id", "item_id", "start", "passage", "words"), run, MATCHES)


def seeded_pairs(docs: DataFrame, items: DataFrame, least: float) -> DataFrame:
    """doc_id, tag, item, n, at: the items that seeds lead to from each text, with the seeds' places."""
    spark = docs.sparkSession
    known = store(spark, item_grams(items), "grams")
    widths = sorted(r.w for r in known.select(F.least("n", F.lit(GRAM)).alias("w")).distinct().collect())  # 1 to GRAM
    if not widths:
        return spark.createDataFrame([], "doc_id long, tag long, item long, n int, at array<int>")
    held = store(spark, held_grams(docs, Bitmap(known, "gram"), widths), "held")
    in_docs = held.groupBy("gram").agg(F.count("*").alias("in_docs"))
    in_items = known.groupBy("gram").agg(F.count("*").alias("in_items"))
    common = (F.col("in_docs") > RARE_DOCS) | ((F.col("in_items") > RARE_ITEMS) & (F.col("in_docs") > RARE_ITEMS))
    rated = store(spark, known.join(in_docs.join(in_items, "gram").select("gram", common.alias("common")), "gram"), "rated")
    pairs = met(held, rated.where("not common").select("gram", "item", "n"), "gram", 3)
    seeds = store(spark, common_seeds(rated.where("common"), items, least), "seeds")
    if not seeds.isEmpty():
        near = store(spark, near_common(docs, seeds, widths), "near")
        some = met(near, seeds.drop("span"), "key", 5).groupBy("doc_id", "tag", "item", "n", "code").agg(F.flatten(F.collect_list("at")).alias("at"), F.sum("places").alias("kept"))
        enough = some.where(F.col("kept") >= F.least(F.lit(KEPT), F.ceil(F.col("n") * F.lit(least))))
        pairs = pairs.drop("gram").unionByName(enough.drop("code", "kept"))
    return pairs.select("doc_id", "tag", "item", "n", "at")


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """doc_id, item_id, score, and the words [first_word, end_word) of the best matching passage, for every pair found."""
    spark = docs.sparkSession
    items = store(spark, item_words(benchmark), "items")
    texts = texts_only(docs).where("doc_id is not null").withColumn("tag", F.xxhash64("text"))
    found = passages(texts, seeded_pairs(texts, items, least), least)
    matched = aligned(met(found, items.select("item", "item_id", "words"), "item", F.size("words") + 2), least)
    best = F.max_by(F.struct("score", "first_word", "end_word"), F.struct("score", -F.col("first_word"), -F.col("end_word")))
    return matched.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")
