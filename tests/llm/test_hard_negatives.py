import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonetally.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, id string, q int, bin int, rank int"


def table(spark, rows):
    return spark.createDataFrame([(k, v, label, "x", 1, 2, 3) for k, v, label in rows], SCHEMA)


def by_hand(rows, every, positives=5, negatives=3):
    known = {}
    for k, v, label in rows:
        if None in (k, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * min(max(x, -(1 << 19)), 1 << 19)) for x in v]
        known[k] = min(known.get(k, (label, q)), (label, q))
    out = set()
    for a, (label, q) in known.items():
        if a % every:
            continue
        scores = {k: sum(x * y for x, y in zip(q, r, strict=False)) for k, (_, r) in known.items() if k != a}
        order = sorted(scores, key=lambda k: (-scores[k], k))
        for p in [k for k in order if known[k][0] == label][:positives]:
            fit = [k for k in order if known[k][0] != label and 50 * scores[p] <= 100 * scores[k] <= 95 * scores[p]]
            out |= {(a, p, r, n, scores[p], scores[n]) for r, n in enumerate(fit[:negatives], 1)}
    return out


def mined(spark, rows, every):
    return [tuple(r) for r in hn.mine(table(spark, rows), F.col("id") % every == 0).collect()]


def test_against_brute_force(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(4, 70))
    rows = [(k, [float(x) for x in centres[k % 4] + draw.normal(size=70) * (0.2 + k % 3)], int(draw.integers(0, 3))) for k in range(300)]
    rows += [(1000 + k, rows[8][1], k % 3) for k in range(60)]  # ties
    rows += [(400, None, 1), (401, [1.0, None], 1), (402, [float("nan")], 1), (403, [float("inf"), 1.0], 1), (404, [1.0], None), (None, [1.0], 1),
             (405, [], 1), (406, [0.5, 0.5], 1), (410, [2.0] * 150, 2), (420, [-1e30, 1e30], 0), (10, rows[10][1], 0), (10, rows[11][1], 9), (20, rows[20][1], rows[20][2])]
    got = mined(spark, rows, 10)
    assert len(got) == len(set(got)) and set(got) == by_hand(rows, 10) and len(got) > 100


def test_more_bins_give_the_same(spark, monkeypatch):
    draw = np.random.default_rng(4)
    rows = [(k, [float(x) for x in draw.normal(size=8) + 1], k % 3) for k in range(400)]
    monkeypatch.setattr(hn, "BIN_ROWS", 40)
    monkeypatch.setattr(hn, "MOST_BIN_ROWS", 40)
    monkeypatch.setattr(hn, "PACK", 16)
    assert set(mined(spark, rows, 7)) == by_hand(rows, 7)


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 2)]])
def test_nothing_to_mine(spark, rows):
    assert mined(spark, rows, 1) == []


def test_bounds_hold_and_drop_pairs():
    draw = np.random.default_rng(6)
    shape = np.repeat(draw.normal(size=(500, 16)), 4, axis=1)
    vectors = np.rint(100 * (shape + 0.1 * draw.normal(size=shape.shape))).astype(np.int32)
    row = {"ids": np.arange(500).tobytes(), "labels": np.zeros(500, np.int64).tobytes(), "vectors": vectors.tobytes(),
           "summaries": [np.stack(level).tobytes() for level in hn.summaries(vectors)]}
    x = hn.Block([row])
    exact = vectors.astype(np.int64) @ vectors.T.astype(np.int64)
    for (mean, spread), length in zip(x.levels, hn.SEGMENTS, strict=True):
        assert (np.abs(exact - length * mean @ mean.T) <= length * spread @ spread.T + 1e-6).all()
    counts: dict[int, int] = {}
    everything = np.full((500, 1), hn._FAR)
    columns, scores, alive = hn.candidates(x, x, np.ones((500, 500), bool), -everything, everything, 3, counts)
    assert counts[64] >= counts[16] >= counts[4] and counts[4] < 0.1 * 500 * 500
    best = np.sort(exact, axis=1)[:, -3:]
    assert (np.sort(np.where(alive, scores, -hn._FAR), axis=1)[:, -3:] == best).all() and (scores == exact[:, columns]).all()
