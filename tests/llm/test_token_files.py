import zlib

import numpy as np
import public_tokenizers
import pytest
from cases import awkward, documents, prose
from tokenizers import Tokenizer

from zonetally.llm import token_files, tokens
from zonetally.llm.text import released
from zonetally.llm.tokens import Encoder

FILES = [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)]


@pytest.mark.parametrize("file,keeps_space", FILES)
def test_pieces_give_the_ids_of_the_whole_text(file, keeps_space):
    path = public_tokenizers.path(file)
    texts = [t or "" for _, t in awkward()] + ["a  b\t\n c \x1c d, e. F.G x!. y", "I'll  'S  \n\nx.", " lead", "trail ", "É. é, A<|ENDOFTEXT|>.", "a\r\nb.\nC"]
    mine = Encoder(path, keeps_space).ids([t.encode() for t in texts], 1)
    whole = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [x.tolist() for x in mine] == [x.ids + [1] for x in whole]


@pytest.mark.parametrize("file,keeps_space", FILES)
def test_words_that_meet_in_one_call(file, keeps_space, monkeypatch):
    """Joined words get their own ids, also with marks, digits, line ends and special tokens; a worker learns them once for all its tasks."""
    path = public_tokenizers.path(file)
    words = ["Ünï", "x1", "don't", "'s", "##", "a|b", "...", "é.", "<|endoftext|>", "a<|endoftext|>b", "ÄŠĠ", "Ġ", "\u0120x", "12", "ſ", "İ", "ａ", "e\u0301"]
    texts = [" ".join(words[k:] + words[:k]) + "\n" + "\n".join(words[::-1]) for k in range(len(words))] + ["", " x", "a b\u2003c", "x  y"]
    whole = [x.ids + [1] for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    learned = []
    learn = Encoder._learn
    monkeypatch.setattr(Encoder, "_learn", lambda self, keys: learned.extend(keys) or learn(self, keys))
    monkeypatch.setattr(tokens, "_encoders", {})
    for _ in range(2):
        out = list(released(lambda batches: iter([tokens.encoder(path, keeps_space).ids([t.encode() for t in texts], 1)]))(iter(())))
        assert [x.tolist() for x in out[0]] == whole
    assert len(learned) == len(set(learned)) > len(words)


def test_words_in_use_outlive_a_memo(monkeypatch):
    monkeypatch.setattr(tokens, "_REMEMBERED", 20)
    path = public_tokenizers.path("byte_bpe_50k.json")
    code, learned, learn = Encoder(path, True), [], Encoder._learn
    monkeypatch.setattr(Encoder, "_learn", lambda self, keys: learned.extend(keys) or learn(self, keys))
    texts = [f"often seen words {prose(k, 12)}." for k in range(30)]
    whole = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [code.ids([t.encode()], 1)[0].tolist() for t in texts] == [x.ids + [1] for x in whole]
    assert learned.count(b"seen") == 1 and len(code.memo) + len(code.older) < 100


def test_codec_round_trip():
    draw = np.random.default_rng(1)
    for high in (1, 256, 257, 70_000, 1 << 24, 1 << 32):
        for n in (1, 2, 3, 4, 5, 1000):
            ranks = draw.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
            assert token_files.unpack_ranks(*token_files.pack_ranks(ranks), n).tolist() == ranks.tolist()
    ids = draw.zipf(1.3, 5000).clip(max=49_000) - 1
    ranks, control, data = token_files.pack_block(ids, 49_408)
    assert token_files.unpack_block(ranks, control, data, len(ids)).tolist() == ids.tolist()
    assert len(control) == 1250 and len(data) < 2 * len(ids)


def test_files_hold_every_document_in_order(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = awkward()
    token_files.write_ids(documents(spark, rows), f"{tmp_path}/ids", path)
    got = token_files.with_starts(token_files.checksums(spark, f"{tmp_path}/ids"), f"{tmp_path}/ids").orderBy("start").collect()
    tokenizer = Tokenizer.from_file(path)
    want = sorted(((k, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for k, t in rows), key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r.doc_id for r in got] == [k for k, _ in want]
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (k or -1, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for k, ids in want)
    ids = {r.doc_id: r.ids for r in token_files.read_ids(spark, f"{tmp_path}/ids").collect()}
    assert ids[12] == next(x for k, x in want if k == 12)


def test_empty_table(spark, tmp_path):
    token_files.write_ids(documents(spark, []), f"{tmp_path}/ids", public_tokenizers.path("word_bpe_49k.json"))
    assert token_files.with_starts(token_files.checksums(spark, f"{tmp_path}/ids"), f"{tmp_path}/ids").count() == 0
