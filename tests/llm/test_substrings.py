import hashlib
import re

import numpy as np
import pytest
from cases import awkward, documents, prose

from zonetally.llm import substrings
from zonetally.llm.text import long_ngram_hashes


def brute(rows, width):
    words = [(k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    first = {}
    for k, w in words:
        if k is not None:
            for i in range(len(w) - width + 1):
                window = tuple(w[i:i + width])
                first[window] = min(k, first.get(window, k))
    out = []
    for k, w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if k is not None and first[tuple(w[i:i + width])] < k:
                gone.update(range(i, i + width))
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k if k is not None else -1, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out)


def digest(tables):
    rows, cut = tables
    lost = {(r.doc_id, r.tag): (r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in cut.collect()}
    out = []
    for r in rows.collect():
        n, sha = (r.n_words, hashlib.sha256(b"").hexdigest()) if r.whole else lost.get((r.doc_id, r.tag), (0, r.sha256))
        out.append((r.doc_id if r.doc_id is not None else -1, r.n_words, n, sha))
    return sorted(out)


@pytest.mark.parametrize("counters", [1 << 20, 1 << 26])
def test_against_brute_force(spark, counters):
    passage = prose(31, 70)
    rows = awkward() + [(k, f"{prose(k, 30)}\n{passage}  {prose(k + 500, 20)}") for k in range(40, 60)]
    rows += [(3, " ".join(passage.split()[5:60])), (60, f"{passage} {passage}"), (61, prose(77, 300)), (62, " ".join(prose(77, 300).split()[:120]) + " end"), (63, prose(88, 49)), (64, prose(88, 49)), (61, prose(79, 90))]
    assert digest(substrings.remove_repeats(documents(spark, rows), counters=counters)) == brute(rows, 50)


def test_full_sketch_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(substrings, "_BLOCK_BITS", 6)
    passage = prose(31, 70)
    rows = [(k, f"{prose(k, 30)} {passage} {prose(k + 500, 20)}") for k in range(20)]
    assert digest(substrings.remove_repeats(documents(spark, rows), counters=64)) == brute(rows, 50)


def test_window_hashes_follow_the_words():
    draw = np.random.default_rng(3)
    for width in (8, 43, 50):
        words = draw.integers(0, 3, 300).astype(np.uint64) + np.uint64(17)
        found = long_ngram_hashes(words, width)
        text = ["".join(map(str, words[i:i + width])) for i in range(300 - width + 1)]
        assert len(found) == len(text) and len({(a, b) for a, b in zip(found.tolist(), text)}) == len(set(text)) == len(set(found.tolist()))


def test_empty_table(spark):
    rows, cut = substrings.remove_repeats(documents(spark, []))
    assert rows.count() == 0 and cut.count() == 0
