"""What the text operators share: words, their hashes and Arrow plumbing.

A word is a run of bytes other than space and 0x09-0x0D, which is what
`bytes.split()` cuts at; UTF-8 never has those bytes inside a character.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries a memo of a Python worker holds before it starts anew; it bounds memory, never results.
MEMO_ENTRIES = 200_000
#: Words handled by one round of vector operations, unless one text alone has more.
CHUNK_WORDS = 60_000


#: What frees the memory that other operators' tasks left in this worker for their next ones.
AT_OTHER_WORK: list[Callable[[], None]] = []


def forget() -> None:
    """To be called as a task begins: workers go from one operator to the next, and memos would add up."""
    for free in AT_OTHER_WORK:
        free()


def _trim() -> None:
    """Gives freed memory back to the system, where the C library can."""
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow after which the worker holds no unused memory, also if it ends early."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            _trim()

    return wrapped


class WordHashes(dict):
    """64-bit hash by word, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > MEMO_ENTRIES:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scrambled so that all its bits depend on all bits of x."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(2 * seed + 0x9E3779B97F4A7C15)) | np.uint64(1)


def ngram_hashes(hashes: np.ndarray, n: int, seed: int = 5) -> np.ndarray:
    """Hash of every n consecutive words, from the hashes of the words; empty if there are fewer."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for k, factor in enumerate(odd_numbers(n, seed)):
            total += hashes[k:k + count] * factor
    return mix(total)


def long_ngram_hashes(hashes: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """As `ngram_hashes` in a time that doesn't grow with n: halves are combined by doubling."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    factors = iter(odd_numbers(2 * n.bit_length() + 2, seed))
    power, width, done, total = hashes, 1, 0, None
    with np.errstate(over="ignore"):
        while True:
            if n & width:
                if total is None:
                    total = power
                else:
                    size = min(len(total), len(power) - done)
                    total = mix(total[:size] * next(factors) + power[done:done + size])
                done += width
            width *= 2
            if width > n:
                return total[:len(hashes) - n + 1]
            power = mix(power[:-(width // 2)] * next(factors) + power[width // 2:])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def texts_only(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator reads; a null text counts as empty. Bytes cross to Python without decoding."""
    return docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).cast("binary").alias(text))


def map_texts(docs: DataFrame, fn: Callable[[list, list[bytes]], pa.RecordBatch], schema: str) -> DataFrame:
    """fn over (keys, texts) of every Arrow batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            if batch.num_rows:
                yield fn(batch.column(0).to_pylist(), batch.column(1).to_pylist())

    return docs.mapInArrow(released(run), schema)


def chunks(keys: list, texts: list[bytes], lower: bool = False) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Keys and word lists, cut so that a chunk has about CHUNK_WORDS words."""
    some_keys: list = []
    some_words: list[list[bytes]] = []
    size = 0
    for key, text in zip(keys, texts, strict=True):
        words = (text.lower() if lower else text).split()
        some_keys.append(key)
        some_words.append(words)
        size += len(words)
        if size >= CHUNK_WORDS:
            yield some_keys, some_words
            some_keys, some_words, size = [], [], 0
    if some_keys:
        yield some_keys, some_words


#: Ids up to which a list of rows to keep or drop is broadcast; longer ones are joined by shuffle.
MOST_IDS = 1_000_000


def _ids(table: DataFrame, key: str) -> DataFrame:
    ids = table.select(key).distinct()
    return F.broadcast(ids) if ids.count() <= MOST_IDS else ids


def only(docs: DataFrame, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows whose key is in `wanted`, a stored table. Texts aren't shuffled for it while the ids are few."""
    return docs.join(_ids(wanted, key), key, "left_semi")


def without(docs: DataFrame, dropped: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows whose key isn't in `dropped`, a stored table. Rows with a null key stay."""
    return docs.join(_ids(dropped, key), key, "left_anti")
