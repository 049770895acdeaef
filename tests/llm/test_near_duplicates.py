import random

import numpy as np
from cases import awkward, documents, prose

from zonetally.llm import near_duplicates as nd
from zonetally.llm.components import components


def brute(rows, percent=75):
    sets = {}
    for k, text in rows:
        words = (text or "").encode().lower().split()
        n = min(5, len(words))
        sets.setdefault(k, []).append(frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if words else frozenset())
    parent = {k: k for k in sets if k is not None}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    ids = sorted(parent)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {k: find(k) for k in parent}, {k: [len(s) for s in v] for k, v in sets.items()}


def edited(text, seed, n):
    draw, words = random.Random(seed), text.split()
    for _ in range(n):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**9)}"
    return " ".join(words)


def test_groups_against_brute_force(spark):
    base, passage = prose(3, 200), prose(4, 90)
    rows = awkward()
    rows += [(100 + k, edited(base, k, k % 9)) for k in range(40)]  # from copies to just below the bound
    rows += [(200 + k, passage + " " + prose(50 + k, 40 + k)) for k in range(30)]  # what they share is not enough
    rows += [(300 + k, base.upper()) for k in range(3)]
    want, sizes = brute(rows)
    got = nd.group(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_shingles in sizes[r.doc_id]
        assert (r.component_id, r.kept) == ((None, True) if r.doc_id is None else (want[r.doc_id], want[r.doc_id] == r.doc_id)), r


def test_prefix_pairs_lose_no_link(spark):
    base = prose(5, 120)
    rows = [(k, edited(base, k, k % 12)) for k in range(60)]
    sets = nd.shingle_sets(documents(spark, rows)).selectExpr("doc_id", "doc_id as root", "shingles")
    pairs = nd.prefix_pairs(sets)
    linked = {(r.a, r.b) for r in nd.verified(pairs, sets.drop("root")).collect()}
    of = {r.doc_id: set(np.frombuffer(r.shingles, np.uint64).tolist()) for r in sets.collect()}
    want = {(a, b) for a in of for b in of if a < b and 100 * len(of[a] & of[b]) >= 75 * len(of[a] | of[b])}
    assert linked == want and want


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(2)
    for share in (0.2, 0.5, 0.8):
        both = draw.integers(0, 1 << 63, 400, dtype=np.uint64)
        n = int(400 * 2 * share / (1 + share) / 2)
        one, two = both[:200], both[200 - n:400 - n]
        s = nd.signatures([one, two], 240)
        assert abs((s[0] == s[1]).mean() - n / (400 - n)) < 0.1
    one = nd.signatures([np.array([7], np.uint64)], 240)[0]
    assert sorted((one >> np.uint64(44)).tolist()) == list(range(240))  # one element takes every slot, one rank after the other


def test_components(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, 200), (200, 100), (300, 300), (200, 150)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, 200: 100, 150: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(spark):
    assert nd.group(documents(spark, [])).count() == 0


def test_signatures_in_slices_are_those_of_the_whole(monkeypatch):
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 700, 3, 0, 2500, 40)]
    whole = nd.signatures(sets, 240)
    monkeypatch.setattr(nd, "WALKERS", 64)
    assert (nd.signatures(sets, 240) == whole).all()


def _form_letters(spark, letters, common, own, more=()):
    rng = np.random.default_rng(6)
    template = rng.integers(1, 2**62, common)
    rows = [(k, k, bytearray(np.sort(np.concatenate([template, rng.integers(1, 2**62, n)])).astype(np.int64).tobytes()))
            for k, n in enumerate([own] * letters + list(more))]
    return spark.createDataFrame(rows, "doc_id long, root long, shingles binary")


def test_form_letters_do_not_meet(spark):
    """300 letters with 156 common and 38 own shingles, and longer ones: the join makes hardly more rows than it reads."""
    sets = _form_letters(spark, 300, 156, 38, more=[45] * 100 + [60] * 50)
    small, large = nd.prefixes(sets)
    read, met = small.count() + large.count(), small.join(large, ["shingle", "level"]).count()
    assert met <= read + 10 * nd.prefix_pairs(sets).count()


def test_sizes_at_the_bound_meet(spark):
    """Letters of 100 to 140 elements, 96 of them common: every pair of at least 75 % is found."""
    own = [4, 4, 11, 18, 20, 20, 28, 32, 33, 44] * 2
    sets = _form_letters(spark, 0, 96, 0, more=own)
    found = {tuple(r) for r in nd.prefix_pairs(sets).collect()}
    for a in range(len(own)):
        for b in range(a + 1, len(own)):
            if 100 * 96 >= 75 * (96 + own[a] + own[b]):
                assert (a, b) in found
