from collections import Counter

import pytest
from cases import awkward, documents

from zonetally.llm import sharding


def test_table_is_even_and_moves_little():
    names = [f"s{k}" for k in range(20)]
    owner = sharding.fill(names, 2003)
    sizes = Counter(owner.tolist())
    assert max(sizes.values()) - min(sizes.values()) <= 1
    fewer = sharding.fill(names[:-1], 2003)
    moved = sum(a != b for a, b in zip(owner, fewer) if a != 19)
    assert moved < 0.15 * 2003
    with pytest.raises(ValueError):
        sharding.fill(names, 2001)


def test_turns_follow_the_preference_order():
    """Brute force: in every round each shard claims the first free slot of its permutation."""
    import xxhash

    names, size = ["a", "b", "c"], 31
    orders = [[(xxhash.xxh64_intdigest(n, seed=1) + j * (xxhash.xxh64_intdigest(n, seed=2) % (size - 1) + 1)) % size for j in range(size)] for n in names]
    owner = {}
    while len(owner) < size:
        for k, order in enumerate(orders):
            free = [s for s in order if s not in owner]
            if free:
                owner[free[0]] = k
    assert sharding.fill(names, size).tolist() == [owner[s] for s in range(size)]


def test_placement(spark, tmp_path):
    names = [f"s{k}" for k in range(7)]
    rows = sharding.place(documents(spark, awkward()), names, slots=97).collect()
    assert len(rows) == len(awkward()) and len({r.shard for r in rows if r.doc_id == 5}) == 1
    owner = sharding.fill(names, 97)
    assert all(r.shard == names[owner[r.slot]] for r in rows)
    assert sharding.place(documents(spark, []), names).count() == 0
    sharding.write_shards(documents(spark, awkward()), f"{tmp_path}/out", names)
    assert spark.read.parquet(f"{tmp_path}/out").count() == len(rows)
