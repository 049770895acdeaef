"""Texts to ids with a given tokenizer file, a piece of text at a time.

Words of a corpus repeat, so ids of pieces are kept in a memo, from task to
task, and a text is put together from them. Arrow finds the distinct pieces of
many texts, so that the memo is asked once for each. Pieces end only where no pretoken can cross:

- at white space, for files whose pretokens have none; before a run of it, for
  byte-level files, where a space belongs to the word behind it;
- between an ASCII letter and a full stop or comma that white space follows.

The ids equal those of the whole text, which the tests check.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from zonetally.llm.text import AT_OTHER_WORK

#: White space as the tokenizer files see it: the Unicode property, without the separators 0x1C-0x1F.
_RUN_AND_WORD = re.compile(r"[^\S\x1c-\x1f]*(?:[^\s]|[\x1c-\x1f])+|[^\S\x1c-\x1f]+")
_MARK = re.compile(rb"[.,](?<=[A-Za-z].)(?=[ \t-\r]|\Z)")
#: White space that `bytes.split` cuts at.
_TO_SPACE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_CONTROLS = bytes(k for k in range(32) if k != 10)
#: With none of these (nor controls), white space is single spaces and line ends between words.
_UNUSUAL_SPACE = (b"  ", b" \n", b"\n ", b"\n\n", b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
#: Keys of the memo for byte-level files say by their first byte what stands before the piece: nothing, else a space.
_START, _TIGHT = b"\x00", b"\x02"
#: Longer pieces are encoded but not remembered.
_LONGEST_KEPT = 64
#: Pieces a worker learns before it begins a new memo. It asks the one before it, too, from which pieces in use move on. It
#: bounds memory, never results.
_REMEMBERED = 500_000


class Encoder:
    """ids(texts) for one tokenizer file; `keeps_space` says whether its pretokens hold white space."""

    def __init__(self, path: str, keeps_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_space = keeps_space
        self.lowers = "Lowercase" in repr(self.tokenizer.normalizer)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.memo: dict = {}
        self.older: dict = {}
        self.border = self._borders()

    def _borders(self) -> np.ndarray | None:
        """By id, whether it ends (begins, if pretokens hold their space) a word, so that many words go through one
        call; None if the vocabulary doesn't show it."""
        shown = np.zeros(self.size, bool)
        for token, k in self.tokenizer.get_vocab(with_added_tokens=False).items():
            shown[k] = token.startswith("\u0120") if self.keeps_space else token.endswith("</w>")
        return shown if shown.any() else None

    def _spaced(self, text: bytes) -> bytes | None:
        """The text with a space between pieces (several count as one piece of nothing); None if it has unusual white space."""
        if not self.keeps_space:  # capitals may spell a special token only after "<|"
            return _MARK.sub(rb" \g<0>", text.lower() if self.lowers and b"<|" not in text else text).translate(_TO_SPACE)
        plain = text and text[:1] not in b" \n" and text[-1:] not in b" \n" and len(text.translate(None, _CONTROLS)) == len(text)
        if plain and not any(x in text for x in _UNUSUAL_SPACE):
            return _START + _MARK.sub(b" \x02\\g<0>", text).replace(b"\n", b" \n")
        return None

    def _spelled(self, key: bytes | str) -> str:
        """The text of a memo key."""
        if isinstance(key, str):
            return key
        if not self.keeps_space or key[:1] == b"\n":
            return key.decode()
        return key[1:].decode() if key[:1] in (_START, _TIGHT) else " " + key.decode()

    def _together(self, keys: list) -> tuple[list, list[str]]:
        """The keys whose pieces go through one call with a space between them, and their words.

        Where pretokens hold their space, such a piece begins with the only space it has, so any word will do that
        spells no special token. Elsewhere a word has to be one pretoken."""
        plain = [key for key in keys if isinstance(key, bytes) and key]
        words = b" ".join(plain).decode().split(" ") if plain else []
        if self.keeps_space:
            some = [(k, w) for k, w in zip(plain, words, strict=True) if w[0] not in "\x00\x02\n" and "<|" not in w]
        else:
            some = [(k, w) for k, w in zip(plain, words, strict=True) if w.isalpha()]
        return [k for k, _ in some], [w for _, w in some]

    def _learn(self, keys: list) -> dict:
        """Ids of these pieces. Plain words go through the tokenizer together."""
        known = {}
        for start in range(0, len(keys), 5_000):
            some = keys[start:start + 5_000]
            if self.border is not None:
                plain, words = self._together(some)
                joined = (" " if self.keeps_space and words else "") + " ".join(words)
                ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.dtype)
                at = np.flatnonzero(self.border[ids])
                if len(at) == len(words):
                    raw, width = ids.tobytes(), self.dtype.itemsize
                    at = (np.append(at, len(ids)) if self.keeps_space else np.append(0, at + 1)) * width
                    at = at.tolist()
                    known.update(zip(plain, [raw[a:b] for a, b in zip(at, at[1:], strict=False)], strict=True))
                    some = [key for key in some if key not in known]
            codes = self.tokenizer.encode_batch_fast([self._spelled(key) for key in some], add_special_tokens=False)
            known.update(zip(some, [np.array(code.ids, self.dtype).tobytes() for code in codes], strict=True))
        return known

    def _of(self, keys: list) -> list[bytes]:
        """Ids of distinct pieces, from the memo or learned."""
        found = list(map(self.memo.get, keys))
        if None in found:
            new = [key for key, ids in zip(keys, found, strict=True) if ids is None]
            known = {key: ids for key, ids in zip(new, map(self.older.get, new), strict=True) if ids is not None}
            known.update(self._learn([key for key in new if key not in known]))
            found = [known[key] if ids is None else ids for key, ids in zip(keys, found, strict=True)]
            self.memo.update((key, ids) for key, ids in known.items() if len(key) <= _LONGEST_KEPT)
        return found

    def _usual(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts whose pieces have a space between them: each distinct piece is looked up once."""
        if not texts:
            return []
        pieces = pc.split_pattern(pa.array([b" ".join(texts)], pa.large_binary()), " ").values.dictionary_encode()
        ids = pa.array(self._of(pieces.dictionary.to_pylist()), pa.large_binary()).take(pieces.indices)
        _, offsets, raw = ids.buffers()
        ends = np.cumsum([text.count(b" ") + 1 for text in texts])
        at = np.frombuffer(offsets, np.int64)[ids.offset:][np.append(0, ends)].tolist()
        return [raw[a:b].to_pybytes() for a, b in zip(at, at[1:], strict=False)]

    def ids(self, texts: list[bytes], end: int) -> list[np.ndarray]:
        """Ids of each text, then `end`."""
        if len(self.memo) > _REMEMBERED:
            self.older, self.memo = self.memo, {}
        last = np.array([end], self.dtype).tobytes()
        spaced = [self._spaced(text) for text in texts]
        usual = iter(self._usual([x for x in spaced if x is not None]))
        out = []
        for text, x in zip(texts, spaced, strict=True):
            if x is None:
                pieces = _RUN_AND_WORD.findall(text.decode())
                distinct = list(set(pieces))
                known = dict(zip(distinct, self._of(distinct), strict=True))
                raw = b"".join([known[piece] for piece in pieces])
            else:
                raw = next(usual)
            out.append(np.frombuffer(raw + last, self.dtype))
        return out


_encoders: dict[tuple[str, bool], Encoder] = {}
AT_OTHER_WORK.append(_encoders.clear)


def encoder(path: str, keeps_space: bool) -> Encoder:
    """The worker's encoder for this file, loaded once."""
    if (path, keeps_space) not in _encoders:
        _encoders[path, keeps_space] = Encoder(path, keeps_space)
    return _encoders[path, keeps_space]


def few_at_a_time(keys: list, texts: list[bytes], size: int = 4_000_000):
    """Keys and texts in runs of about `size` bytes."""
    some_keys: list = []
    some_texts: list[bytes] = []
    total = 0
    for key, text in zip(keys, texts, strict=True):
        some_keys.append(key)
        some_texts.append(text)
        total += len(text)
        if total >= size:
            yield some_keys, some_texts
            some_keys, some_texts, total = [], [], 0
    if some_keys:
        yield some_keys, some_texts
