import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import awkward, documents, prose

from zonetally.llm import lexical_search as ls


def by_hand(rows, items, most=10):
    def terms(text):
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)

    docs = [(k, Counter(t)) for k, text in rows if (t := terms(text))]
    n_docs, n_terms = len(docs), sum(tf.total() for _, tf in docs)
    df = Counter(t for _, tf in docs for t in tf)
    out = []
    asked = {}
    for k, text in items:
        if k is not None:
            asked.setdefault(k, set()).update(terms(text))
    for item, wanted in asked.items():
        scores = []
        for k, tf in docs:
            m = 10 + 90 * tf.total() * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in wanted if tf[t])
            if k is not None and score > 0:
                scores.append((-score, k))
        out += [(item, r, k, -s) for r, (s, k) in enumerate(sorted(scores)[:most], 1)]
    return sorted(out)


def found(spark, rows, items, most=10):
    table = spark.createDataFrame([(k, t, 1, "x") for k, t in items], "item_id long, text string, doc_id int, rank string")
    return sorted(tuple(r) for r in ls.search(documents(spark, rows), table, most).collect())


def test_against_brute_force(spark):
    draw = random.Random(2)
    rows = awkward() + [(100 + k, prose(k, draw.randint(1, 200))) for k in range(150)]
    rows += [(400 + k, f"Common {prose(3, 12)}. {prose(k % 5, 30)}") for k in range(80)]  # copies and ties
    rows += [(None, prose(2, 70)), (600, "word " * 300 + prose(4, 9)), (601, "ÉTÉ été Été 2nd x_y"), (600, prose(5, 20))]
    items = [(k, prose(k, 25)) for k in range(12)] + [(20, "common word word"), (21, "été ÉTÉ X y"), (22, ""), (23, None), (24, "!!"), (25, "absent"), (None, "word"), (0, "common")]
    assert found(spark, rows, items) == by_hand(rows, items)
    assert found(spark, rows, items, 3) == by_hand(rows, items, 3)
    assert found(spark, rows, []) == found(spark, [], items) == found(spark, [(1, None), (2, " ")], items) == []


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = [(k, prose(k % 70, 5 + k % 40)) for k in range(200)]
    items = [(k, prose(k, 20)) for k in range(70)]
    monkeypatch.setattr(ls, "BIN_BYTES", 2_000)
    monkeypatch.setattr(ls, "PROMISING", 1)
    assert found(spark, rows, items) == by_hand(rows, items)


def test_bounds_are_never_below_the_score():
    draw = random.Random(8)
    block, hashes, texts = ls._Block(), ls.WordHashes(), []
    for k in range(60):
        tf = Counter(ls.terms(prose(k, draw.randint(30, 60)).encode()))
        texts.append(tf)
        block.add(k, tf.total(), hashes.of(list(tf)), tf)
    row = block.row(1).to_pylist()[0]
    total = sum(t.total() for t in texts)
    vocabulary = sorted({t for tf in texts for t in tf})
    weights = np.array([[draw.randint(0, 9) for _ in vocabulary] for _ in range(7)], float)
    (ids, bounds), = ls._Index([row], 60, total).bounds(weights, hashes.of(vocabulary))
    for k, tf in enumerate(texts):
        m = np.array([10 + 90 * tf.total() * 60 // total])
        exact = [sum(w * int(ls.saturation(tf[t], m)[0]) for t, w in zip(vocabulary, own, strict=True) if tf[t]) for own in weights]
        assert (bounds[:, k] >= exact).all()
    assert list(ids) == list(range(60))


def test_floor_leaves_few_candidates(spark, monkeypatch):
    rows = [(k, prose(k, 60)) for k in range(600)]
    items = [(k, prose(k, 25)) for k in range(20)]
    kept = {}
    monkeypatch.setattr(ls, "store", lambda spark, df, name, real=ls.store: kept.setdefault(name, real(spark, df, name)))
    assert found(spark, rows, items) == by_hand(rows, items)
    assert kept["candidates"].count() < 0.25 * 20 * 600


@pytest.mark.parametrize("top,want", [(1, [1]), (2, [1, 2]), (9, [1, 2, 3, 5, 9]), (16, [1, 2, 3, 5, 9])])
def test_steps(top, want):
    assert ls.steps(top) == want
