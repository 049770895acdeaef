"""Quality rules on repetition inside a document, by a suffix array over its words.

A chunk of documents shares one suffix array: words of different documents
count as different, so suffixes of one document lie together. Prefix doubling
sorts them, each round only those that still tie. Neighbours' longest common
prefixes come from the ranks of the rounds. For each word, the longer of the
prefixes shared with both neighbours is the longest repeat that starts there;
the union of such spans of `least` words or more covers all occurrences of all
maximal repeated substrings of that length.

Null and empty texts have no words and fail the base rule. Every row is judged
by its own text, so repeated rows get the same verdict; a null doc_id stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from zonetally.llm.text import WordHashes, chunks, forget, map_texts, mix, released, texts_only

_SPACE = bytes([32, *range(9, 14)])
_NOT_COUNTED = _SPACE + bytes(range(0x80, 0xC0))  # white space, and bytes that continue a character
_SYMBOLS = b"#*$%&|<>"

#: A repeat counts for the verdict from so many words on.
LEAST = 10
#: Largest covered share of the words, in percent, and longest single repeat, in words, of a document that is kept.
MOST_COVERED, LONGEST = 40, 400

_OUT = {"n_words": pa.int64(), "word_chars": pa.int64(), "n_symbols": pa.int64(), "n_dup_lines": pa.int64(),
        "n_repeat_words": pa.int64(), "base_failed": pa.bool_(), "covered_words": pa.int64(), "longest_repeat": pa.int64(),
        "kept": pa.bool_()}


def suffix_ranks(symbols: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... symbols, till all differ. last: by position, the last
    position of its document; a suffix ends there."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    new = np.append(True, symbols[order][1:] != symbols[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    levels, width = [rank], 1
    ties = np.bincount(rank, minlength=n)[rank] > 1
    active = np.flatnonzero(ties)
    while len(active):
        behind = active + width
        follow = np.where(behind <= last[active], rank[np.minimum(behind, n - 1)] + 1, 0)
        by = np.argsort(rank[active] * (n + 1) + follow, kind="stable")
        active, follow = active[by], follow[by]
        old = rank[active]
        group = np.append(True, old[1:] != old[:-1])
        part = group | np.append(True, follow[1:] != follow[:-1])
        at = np.arange(len(active))
        moved = at[part][np.cumsum(part) - 1] - at[group][np.cumsum(group) - 1]
        rank = rank.copy()
        rank[active] = old + moved
        levels.append(rank)
        width *= 2
        size = np.diff(np.append(np.flatnonzero(part), len(active)))
        active = active[(size > 1)[np.cumsum(part) - 1]]
    return levels


def longest_repeats(symbols: np.ndarray, last: np.ndarray) -> np.ndarray:
    """By position, the length of the longest substring that starts there and occurs elsewhere in the document."""
    n = len(symbols)
    longest = np.zeros(n + 1, np.int64)
    if n < 2:
        return longest[:n]
    levels = suffix_ranks(symbols, last)
    suffixes = np.empty(n, np.int64)
    suffixes[levels[-1]] = np.arange(n)
    left, right = suffixes[:-1], suffixes[1:]
    same = levels[0][left] == levels[0][right]
    left, right = left[same], right[same]
    i, j = left.copy(), right.copy()
    lcp = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        padded = np.append(levels[k], [-1])  # beyond the chunk
        inside = (i <= last[left]) & (j <= last[right])
        step = (inside & (padded[np.minimum(i, n)] == padded[np.minimum(j, n)]) & (i != j)).astype(np.int64) << k
        lcp, i, j = lcp + step, i + step, j + step
    np.maximum.at(longest, left, lcp)
    np.maximum.at(longest, right, lcp)
    return longest[:n]


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """By position, whether a span [start, start + length) covers it."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + lengths, -1)
    return np.cumsum(edges[:-1]) > 0


def chunk_measures(words: list[list[bytes]], hashes: WordHashes, least: int) -> tuple[np.ndarray, ...]:
    """Of each document: words in 3-word windows that repeat, words in repeats of `least` or more, the longest repeat."""
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes)
    of = np.repeat(np.arange(len(words)), sizes)
    n = len(of)
    flat = hashes.of([w for some in words for w in some])
    with np.errstate(over="ignore"):
        symbols = mix(flat + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    repeat = longest_repeats(symbols, (ends - 1)[of])
    in_windows = covered(at := np.flatnonzero(repeat >= 3), np.full(len(at), 3), n)
    in_repeats = covered(at := np.flatnonzero(repeat >= least), repeat[at], n)
    longest = np.zeros(len(words), np.int64)
    np.maximum.at(longest, of, repeat)
    return np.bincount(of[in_windows], minlength=len(words)), np.bincount(of[in_repeats], minlength=len(words)), longest


def plain_counts(text: bytes) -> tuple[int, int, int]:
    """word_chars, n_symbols, n_dup_lines."""
    lines = [line for line in text.split(b"\n") if line.strip(_SPACE)]
    return len(text.translate(None, _NOT_COUNTED)), len(text) - len(text.translate(None, _SYMBOLS)), len(lines) - len(set(lines))


def verdicts(texts: list[bytes], hashes: WordHashes, least: int, most_covered: int, longest: int) -> list[tuple]:
    """Of each text: words, words in repeated 3-word windows, whether the base rule fails, covered words, the longest
    repeat, kept."""
    out = []
    for _, words in chunks(texts, texts):
        for triples, spans, most, n in zip(*(x.tolist() for x in chunk_measures(words, hashes, least)), (len(w) for w in words), strict=True):
            failed = n < 50 or 100 * triples > 50 * n
            out.append((n, triples, failed, spans, most, not failed and 100 * spans <= most_covered * n and most <= longest))
    return out


def passing(docs: DataFrame, text: str = "text", least: int = LEAST, most_covered: int = MOST_COVERED, longest: int = LONGEST) -> DataFrame:
    """The rows that are kept, with all their columns; nothing is shuffled."""
    hashes = WordHashes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            texts = [x.encode() if x else b"" for x in batch[text].to_pylist()]
            yield batch.filter(pa.array([x[-1] for x in verdicts(texts, hashes, least, most_covered, longest)], pa.bool_()))

    return docs.mapInArrow(released(run), docs.schema)


def judge(docs: DataFrame, least: int = LEAST, most_covered: int = MOST_COVERED, longest: int = LONGEST) -> DataFrame:
    """The measures and verdict of every document; nothing is shuffled."""
    hashes = WordHashes()

    def run(keys: list, texts: list[bytes]) -> pa.RecordBatch:
        n, triples, failed, spans, most, kept = zip(*verdicts(texts, hashes, least, most_covered, longest), strict=True)
        columns = [n, *zip(*map(plain_counts, texts), strict=True), triples, failed, spans, most, kept]
        arrays = [pa.array(keys, pa.int64()), *(pa.array(c, t) for c, t in zip(columns, _OUT.values(), strict=True))]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", *_OUT])

    names = {pa.int64(): "long", pa.bool_(): "boolean"}
    return map_texts(texts_only(docs), run, ", ".join(["doc_id long", *(f"{k} {names[t]}" for k, t in _OUT.items())]))
