from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from cases import awkward, documents, prose
from tokenizers import Tokenizer

from zonetally.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_patterns_place_every_piece():
    draw = np.random.default_rng(4)
    histogram = dict(Counter(draw.integers(1, 2049, 5000).tolist())) | {2048: 300, 3: 4000}
    found = packing.patterns(histogram, 2048)
    placed = Counter()
    for packs, parts in found:
        assert packs > 0 and sum(length * times for length, times in parts) <= 2048
        for length, times in parts:
            placed[length] += packs * times
    assert placed == histogram
    assert sum(k * n for k, n in histogram.items()) > 0.97 * 2048 * sum(p for p, _ in found)
    assert packing.patterns({}, 2048) == []


def test_pieces_and_places(spark):
    rows = awkward() + [(100 + k, prose(k, 40)) for k in range(60)]
    got = packing.pack(documents(spark, rows), PATH, length=256).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter((k, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])) for k, t in rows)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length <= 256
        pieces[r.doc_id, r.doc_tokens].append((r.start, tuple(ids.tolist())))
        sequences[r.sequence_id].append((r.offset, r.length))
    for (k, ids), n in want.items():
        whole = sorted((s, ids[s:s + 256]) for s in range(0, len(ids), 256))
        assert Counter(pieces[k, len(ids)])[whole[0]] == n and set(whole) <= set(pieces[k, len(ids)])
    assert sum(len(p) for _, x in pieces.items() for _, p in x) == sum(len(ids) * n for (_, ids), n in want.items())
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256


def test_shuffled_offsets_agree(spark, monkeypatch):
    rows = [(k, prose(k, 30 + k % 5)) for k in range(80)]
    one = {(r.doc_id, r.start): (r.sequence_id, r.offset) for r in packing.pack(documents(spark, rows), PATH, length=128).collect()}
    monkeypatch.setattr(packing, "MOST_BROADCAST", 0)
    assert one == {(r.doc_id, r.start): (r.sequence_id, r.offset) for r in packing.pack(documents(spark, rows), PATH, length=128).collect()}


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), PATH).count() == 0
