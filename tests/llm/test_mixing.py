import random
from collections import defaultdict

import pytest
from cases import documents, prose
from pyspark.sql import functions as F

from zonetally.llm import mixing



def weight():
    return F.element_at(F.array(F.lit(5), F.lit(2), F.lit(1)), (F.col("nth") % 3 + 1).cast("int"))


def rows(n, seed=1):
    draw = random.Random(seed)
    sources = ["b", "a", None, "é", "Z", "tiny"]
    return [(k, prose(k, draw.randint(0, 400)), sources[0 if draw.random() < 0.4 else draw.randrange(5)]) for k in range(n)] + [
        (n, None, "a"), (None, "one two", "a"), (None, "three", None), (n + 1, "  \n", "empty"), (n + 2, "x y z", "tiny"), (1, prose(1, 20), "b"), (1, prose(1, 20), "b")]


def table(spark, some):
    return documents(spark, [(k, t) for k, t, _ in some]).limit(0).unionByName(spark.createDataFrame(
        [(k, t, "en", s, 1, 2, "x", "y") for k, t, s in some], "doc_id long, text string, lang string, source string, n_chars long, shard int, base string, rank string"))


def by_hand_targets(size, share=1.5, most=2):
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    capped, left = {}, share * sum(size.values())
    while True:
        free = [s for s in names if s not in capped]
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level >= most * size[s]]
        if not over:
            return names, {**{s: weight[s] * level for s in free}, **capped}
        for s in over:
            capped[s] = float(most * size[s])
            left -= capped[s]


def seats(names, targets, limits, house):
    """By highest quotients, one seat at a time."""
    won = dict.fromkeys(names, 0)
    for _ in range(house):
        open_ = [s for s in names if won[s] < limits[s]]
        if not open_:
            break
        best = max(open_, key=lambda s: targets[s] / (2 * won[s] + 1))  # the first of equal ones
        won[best] += 1
    return won


@pytest.mark.parametrize("block,shards", [(64, 16), (7, 3)])
def test_targets_quotas_and_pieces(spark, block, shards):
    some = rows(300)
    got = mixing.mix(table(spark, some), weight(), block=block, shards=shards).collect()
    size = defaultdict(int)
    for _, text, source in some:
        size[source] += len((text or "").split())
    names, targets = by_hand_targets(size)
    assert len(got) == len(some)
    house = round(sum(targets.values()) / block)
    limits = {s: 2 * -(-size[s] // block) for s in names}
    quota = {j: seats(names, targets, limits, house * (j + 1) // shards) for j in range(shards)}
    blocks, words = defaultdict(lambda: defaultdict(int)), defaultdict(int)
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(targets[r.source], abs=1e-6)
        place = 0
        for p in r.pieces or []:
            assert place <= p.start and p.length > 0 and p.start + p.length <= r.size and len(p.shards) == p.copies <= 2
            place = p.start + p.length
            words[r.source] += p.length * p.copies
            for shard in p.shards:
                blocks[r.source][shard] += p.length
    for s in names:
        # near the target by half a block for the quota, and by what the source's last block is short, twice at most
        assert abs(words[s] - targets[s]) <= 3.5 * block
        if limits[s]:
            for j in range(shards):
                want = quota[j][s] - (quota[j - 1][s] if j else 0)
                assert (want - 2) * block <= blocks[s][j] <= want * block
    assert sum(quota[shards - 1].values()) == min(house, sum(limits.values()))


def test_reruns_and_other_layouts_agree(spark):
    some = rows(120)
    one = mixing.mix(table(spark, some), weight())
    two = mixing.mix(table(spark, some[::-1]).repartition(7), weight())
    key = ["doc_id", "source", "size", "source_size", "target", "pieces"]
    assert sorted(map(str, one.select(key).collect())) == sorted(map(str, two.select(key).collect()))
    other = mixing.mix(table(spark, some), weight(), seed=2)
    assert sorted(map(str, one.select(key).collect())) != sorted(map(str, other.select(key).collect()))


def test_chunks_don_t_matter(spark, monkeypatch):
    some = table(spark, rows(200))
    one = sorted(map(str, mixing.mix(some, weight()).collect()))
    monkeypatch.setattr(mixing, "CHUNK_DOCS", 10)
    assert sorted(map(str, mixing.mix(some, weight()).collect())) == one


def test_empty_and_wordless(spark):
    assert mixing.mix(table(spark, []), weight()).count() == 0
    got = mixing.mix(table(spark, [(1, None, "a"), (2, "", None)]), weight()).select("size", "target", mixing.taken().alias("taken")).collect()
    assert [tuple(r) for r in got] == [(0, 0.0, 0)] * 2


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 720, 30030])
def test_stride_is_a_permutation(n):
    a, b = mixing.stride(n, 3)
    assert sorted((a * x + b) % n for x in range(n)) == list(range(n))
