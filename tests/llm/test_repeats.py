import re
from collections import Counter

import numpy as np
import pytest
from cases import awkward, documents, prose

from zonetally.llm import repeats
from zonetally.llm.text import WordHashes


def longest_by_hand(words):
    n = len(words)
    out = []
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


@pytest.mark.parametrize("texts", [["a a a a a", "a b a b a b c", "x", "", "a b c"], ["a b c d a b c", "a b c d a b c"], [prose(1, 60) + " " + prose(1, 60)]])
def test_longest_repeats(texts):
    words = [t.encode().split() for t in texts]
    of = np.repeat(np.arange(len(words)), [len(w) for w in words])
    last = (np.cumsum([len(w) for w in words]) - 1)[of]
    symbols = np.array([hash((int(d), w)) & (2**63 - 1) for d, w in zip(of, [w for some in words for w in some])], np.uint64)
    assert repeats.longest_repeats(symbols, last).tolist() == [x for some in words for x in longest_by_hand(some)]


def expected(text, least=repeats.LEAST):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)

    def cover(size):
        count = Counter(tuple(words[i:i + size]) for i in range(n - size + 1))
        return len({j for i in range(n - size + 1) if count[tuple(words[i:i + size])] > 1 for j in range(i, i + size)})

    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    triples = cover(3)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), triples, n < 50 or 100 * triples > 50 * n, cover(least))


def test_measures_against_brute_force(spark):
    part = prose(7, 30)
    rows = awkward() + [(20, f"{part} {prose(8, 200)} {part}"), (21, f"{part} " * 6), (22, "a | b\na | b\n\n \na | b\n" + prose(3, 60)), (23, f"{prose(5, 100)} {prose(5, 100)} " + prose(6, 60))]
    got = repeats.judge(documents(spark, rows)).collect()
    texts = {}
    for k, t in rows:
        texts.setdefault(k, set()).add(t)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.covered_words) in {expected(t) for t in texts[r.doc_id]}
        assert not (r.kept and r.base_failed)
    by = {r.doc_id: r for r in got}
    assert by[20].longest_repeat == 30 and by[20].covered_words == 60 and by[20].kept
    assert by[23].longest_repeat == 100 and not by[23].kept
    kept = sorted(r.doc_id or -1 for r in repeats.passing(documents(spark, rows)).collect())
    assert kept == sorted(r.doc_id or -1 for r in got if r.kept)


def test_empty_table(spark):
    assert repeats.judge(documents(spark, [])).count() == 0
    assert repeats.passing(documents(spark, [])).count() == 0


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr("zonetally.llm.text.MEMO_ENTRIES", 10)
    hashes = WordHashes()
    words = [str(k).encode() for k in range(100)]
    assert hashes.of(words).tolist() == hashes.of(words).tolist() and len(hashes) == 100
