import time

import numpy as np
import pytest
from cases import awkward, documents, prose
from pyspark.sql import functions as F

from zonetally.llm import decontamination as dc


def by_hand(item, passage):
    best = 0
    h = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a == b else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_against_brute_force():
    draw = np.random.default_rng(5)
    for _ in range(60):
        item, passage = draw.integers(1, 5, draw.integers(1, 20)), draw.integers(1, 5, draw.integers(0, 40))
        score, first, last = dc.alignment(item, passage)
        assert score == by_hand(item, passage)
        assert by_hand(item, passage[first:last]) == score


def test_copies_and_edits_are_found(spark):
    items = {k: prose(400 + k, 20 + k) for k in range(12)} | {50: "alpha beta", 51: "", 52: None}
    edit = items[4].split()
    edit[6], edit[13] = "changed", "again"
    edit.insert(10, "inserted")
    rows = awkward() + [
        (100, f"{prose(1, 40)} {items[3].upper()}! {prose(2, 40)}"), (101, f"{prose(3, 30)} {' '.join(edit)} {prose(4, 30)}"),
        (102, f"{items[5]} {items[6]}"), (103, f"{prose(5, 30)} {' '.join(items[7].split()[:6])} {prose(6, 30)}"), (104, "then alpha, beta came"),
        (None, items[8]), (105, items[9]), (105, prose(9, 50)), *((200 + k, f"{prose(k, 15)} {items[10]}") for k in range(50)),
    ]
    benchmark = spark.createDataFrame([(k, t, 1) for k, t in items.items()] + [(None, items[1], 1)], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id): r for r in dc.contaminated(documents(spark, rows), benchmark).collect()}
    assert set(got) == {(100, 3), (101, 4), (102, 5), (102, 6), (104, 50), (105, 9), *((200 + k, 10) for k in range(50))}
    assert got[100, 3].score == 1.0 and (got[100, 3].first_word, got[100, 3].end_word) == (40, 63)
    assert 0.6 < got[101, 4].score < 1
    assert dc.contaminated(documents(spark, []), benchmark).count() == 0
    assert dc.contaminated(documents(spark, rows), benchmark.limit(0)).count() == 0


def edited(words, every, kind):
    out = []
    for k, word in enumerate(words):
        change = k % every == every - 1
        if not (change and kind == "drop"):
            out.append(f"new{k}" if change and kind == "change" else word)
        if change and kind == "insert":
            out.append(f"new{k}")
    return out


def test_edited_copies_against_brute_force(spark):
    items = {k: prose(700 + k, n).split() for k, n in enumerate([12, 15, 12, 23, 31, 40, 9, 18])}
    near = [(k, "change", 5) for k in items] + [(k, kind, every) for k in items for kind in ("change", "drop", "insert") for every in (4, 6, 7)]
    docs = {n: [*prose(2 * n, 9).split(), *edited(items[k], every, kind), *prose(2 * n + 1, 9).split()] for n, (k, kind, every) in enumerate(near)}
    docs[900] = [*prose(900, 5).split(), *items[0][:5], "another", *items[0][6:]]
    docs[901] = ["changed" if k in (4, 9) else word for k, word in enumerate(items[1])]
    docs[902] = [*items[5][:20], *prose(902, 30).split(), *items[5][20:]]  # many words let into the middle
    want = {(d, k): score / (2 * len(item)) for d, words in docs.items() for k, item in items.items()
            if (score := by_hand(item, words)) >= len(item)}
    got = dc.contaminated(documents(spark, [(d, " ".join(words)) for d, words in docs.items()]),
                          spark.createDataFrame([(k, " ".join(item)) for k, item in items.items()], "item_id long, text string"))
    assert {(r.doc_id, r.item_id): r.score for r in got.collect()} == want
    assert want[900, 0] == 0.875 and want[901, 1] == 0.8 and want[902, 5] == 0.625 and len(want) >= len(near)


def test_common_grams_and_salted_joins_give_the_same(spark, monkeypatch):
    items = {k: prose(700 + k, n).split() for k, n in enumerate([12, 15, 12, 23, 31, 40, 9, 18, 2, 1])}
    docs = [(10 * k + every, f"{prose(k, 20)} {' '.join(edited(words, every, kind))} {prose(90 + k, 15)}") for k, words in items.items()
            for every, kind in ((4, "change"), (5, "insert"), (6, "drop"), (7, "change"))]
    docs, benchmark = documents(spark, docs), spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    plain = sorted(map(tuple, dc.contaminated(docs, benchmark).collect()))
    assert len({r[1] for r in plain}) == len(items)
    monkeypatch.setattr(dc, "MOST_NUMBERS", -1)
    monkeypatch.setattr(dc, "RARE_DOCS", 0)  # every gram is a common one
    monkeypatch.setattr(dc, "LISTED", 1)
    assert sorted(map(tuple, dc.contaminated(docs, benchmark).collect())) == plain


def test_items_that_share_a_gram_are_aligned_only_where_their_words_are(spark):
    draw = np.random.default_rng(4)
    letters = np.array([f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "bdfgklmnprst"] * 12, object) + np.repeat([f"o{k}" for k in range(12)], 720)
    items = [(k, "which of the " + " ".join(draw.choice(letters, 14))) for k in range(10_000)]
    docs = [(k, f"{' '.join(draw.choice(letters, 60))} which of the {' '.join(draw.choice(letters, 60))}") for k in range(60)]
    docs += [(100 + k, f"{' '.join(draw.choice(letters, 40))} {items[k][1]} {' '.join(draw.choice(letters, 40))}") for k in range(40)]
    texts = dc.texts_only(documents(spark, docs)).withColumn("tag", F.xxhash64("text"))
    known = dc.store(spark, dc.item_words(spark.createDataFrame(items, "item_id long, text string")), "items")
    pairs = dc.seeded_pairs(texts, known, 0.5).groupBy("doc_id", "item").count().count()
    assert 40 <= pairs < 0.03 * 100 * 10_000  # all of them hold the gram
    got = dc.contaminated(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(100 + k, k) for k in range(40)}


def test_share_found_of_items_with_every_third_word_changed(spark):
    items = {k: prose(1700 + k, 10 + k % 20).split() for k in range(60)}
    docs = {k: [*prose(k, 9).split(), *edited(words, 3, "change"), *prose(k + 99, 9).split()] for k, words in items.items()}
    want = {k for k, words in docs.items() if by_hand(items[k], words) >= len(items[k])}
    got = dc.contaminated(documents(spark, [(k, " ".join(w)) for k, w in docs.items()]),
                          spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string"))
    found = {r.doc_id for r in got.collect() if r.doc_id == r.item_id}
    print(f"every third word: {len(found & want)} of {len(want)} found")
    assert found <= want and len(want) > 30


@pytest.mark.parametrize("text,words", [("Don't É-2 x", ["don", "t", "é", "2", "x"]), ("", [])])
def test_words(text, words):
    assert [w.decode() for w in dc.plain_words(text.encode())] == words


def test_hashes_of_many_texts_are_those_of_their_words(monkeypatch):
    monkeypatch.setattr(dc, "CHUNK_WORDS", 5)
    lengths = [1, 2, 7, 8, 9, 15, 16, 17, 63, 64, 65, 200]
    words = [letter * n for n in lengths for letter in "ab"] + [f"{'a' * (n - 1)}b" for n in lengths[1:]] + [f"b{'a' * (n - 1)}" for n in lengths[1:]]
    texts = ["", " ".join(words), "...", words[5], " ".join(words[::-1]).upper(), "É-2 İstanbul\0日本語\x80x Don't", "", "a\x00b a\tb\n", "-a"]
    texts = [text.encode() for text in texts]
    hashes, sizes = dc.word_hashes(texts)
    known = [word for text in texts for word in dc.plain_words(text)]
    assert sizes.tolist() == [len(dc.plain_words(text)) for text in texts]
    assert len(hashes) == len(known) and len(set(hashes.tolist())) == len(set(known)) == len(set(zip(known, hashes.tolist(), strict=True)))
    assert [len(part) for part in dc.word_hashes([b"", b""])] == [0, 2]


def test_hashing_takes_a_fraction_of_the_time_of_one_word_after_the_other():
    texts = [prose(k, 3_000).encode() for k in range(100)]

    def seconds(fn):
        def once():
            start = time.process_time()
            fn()
            return time.process_time() - start
        return min(once() for _ in range(3))

    def one_by_one():
        memo = {}
        for text in texts:
            for word in dc.plain_words(text):
                memo.setdefault(word, len(memo))

    assert seconds(lambda: dc.word_hashes(texts)) < 0.7 * seconds(one_by_one)
