import numpy as np
from cases import awkward, documents, prose

from zonetally.llm import preference as pf


def test_fit_orders_pairs():
    draw = np.random.default_rng(6)
    x = draw.normal(size=(4000, 5))
    truth = np.array([2.0, -1.0, 0.0, 0.5, 0.0])
    y = draw.random(4000) < 1 / (1 + np.exp(-(x @ truth + 1)))
    model = pf.fit(x[y], x[~y], float((~y).mean()))
    angle = model.weights / model.spread @ truth / np.linalg.norm(model.weights / model.spread) / np.linalg.norm(truth)
    assert angle > 0.98
    assert abs((model.scores(x) < pf.CUT).mean() - (~y).mean()) < 0.02


def test_held_out_documents(spark):
    def text(k):
        return prose(k, 60) if k % 3 else " ".join(w.upper() + "!!" for w in prose(k, 60).split())

    rows = awkward() + [(1000 + k, text(k)) for k in range(300)]
    labels = spark.createDataFrame([(1000 + k, int(k % 3 > 0), "z") for k in range(200)] + [(None, 1, ""), (3, None, ""), (5, 7, "")], "doc_id long, quality int, text string")
    docs = documents(spark, rows)
    got = pf.score(docs, pf.learn(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all((r.score >= pf.CUT) == ((r.doc_id - 1000) % 3 > 0) for r in got if r.doc_id and r.doc_id >= 1200)
    assert pf.learn(docs, labels.where("quality = 1")) is None
    assert {r.score for r in pf.score(docs, None).collect()} == {0.5}
    assert pf.score(documents(spark, []), None).count() == 0


def test_features_have_one_length():
    assert {len(pf.features((t or "").encode())) for _, t in awkward()} == {pf.N_FEATURES}


def test_weights_settle_over_all_pairs():
    """The slope of the mean loss, summed pair by pair, vanishes at the weights; the cut leaves as many rows below as are bad."""
    draw = np.random.default_rng(8)
    good, bad = draw.normal(size=(700, 4)) + [0.8, 0, -0.3, 0.1], draw.standard_t(3, size=(450, 4))
    model = pf.fit(good, bad, 450 / 1150)
    one, two = model.scaled(good), model.scaled(bad)
    lose = 1 / (1 + np.exp((one @ model.weights)[:, None] - two @ model.weights))
    slope = (lose.sum(axis=0) @ two - lose.sum(axis=1) @ one) / lose.size + 1e-3 * model.weights
    assert np.abs(slope).max() < 1e-5
    assert (model.scores(np.concatenate([good, bad])) < pf.CUT).sum() == 450


def test_every_labelled_row_counts(spark):
    """More rows than any sample once held: weights and cut are those of all, and one row more changes them."""
    rows = [(k, " ".join(w.upper() if (k * 7 + n) % 5 < k % 3 else w for n, w in enumerate(prose(k, 6 + k % 9).split()))) for k in range(12_000)]
    docs = documents(spark, rows).repartition(5)
    labels = spark.range(12_000).selectExpr("id as doc_id", "cast(id % 3 <> 1 and id % 11 <> 5 or id % 13 = 2 as int) as quality")
    x = np.array([pf.features(text.encode()) for _, text in rows])
    y = np.array([r.quality for r in labels.orderBy("doc_id").collect()]) == 1
    model, want = pf.learn(docs, labels), pf.fit(x[y], x[~y], float((~y).mean()))
    assert np.allclose(model.weights, want.weights, atol=1e-5) and abs(model.cut - want.cut) < 1e-5
    assert (~y).sum() - (model.scores(x) < pf.CUT).sum() in (0, 1)
    fewer = pf.learn(docs, labels.where("doc_id <> 11999"))
    assert np.abs(fewer.weights - model.weights).max() > 1e-6


def test_order_statistics(spark):
    values = [3.0] * 50 + [1.0, -2.5, 1e300, 5e-324, 0.0] + [float(k) / 7 for k in range(90)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    assert [pf._order_statistic(rows, "v", k, 4) for k in range(0, len(values), 9)] == sorted(values)[::9]


def test_labels_joined_by_shuffle(spark, monkeypatch):
    docs = documents(spark, [(k, prose(k, 20 + k % 7).upper() if k % 4 == 0 else prose(k, 20)) for k in range(200)])
    labels = spark.range(200).selectExpr("id as doc_id", "cast(id % 4 > 0 as int) as quality")
    one = pf.learn(docs, labels)
    monkeypatch.setattr(pf, "MOST_IDS", 0)
    two = pf.learn(docs, labels)
    assert np.allclose(one.weights, two.weights, atol=1e-6) and abs(one.cut - two.cut) < 1e-6
