"""Ids of byte-level BPE texts, word by word and remembered, equal to the library's for the whole text."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from struct import pack

import numpy as np

#: Words of one generation that a worker remembers; a full one makes way for the next, which takes over what is met again.
MEMO = 1 << 19
#: Pre-tokens that are the same whatever stands around them: letters of the Latin blocks with a blank before them, marks,
#: and a line end between a character and a letter.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_MARKS = r"!-&(-/:-@\[-`{-~"
_PARTS = re.compile(rf" ?[{_LETTERS}]++|[{_MARKS}]++|(?<=[{_MARKS}{_LETTERS}])\n(?=[{_LETTERS}])")
_PLAIN = re.compile(rf"(?:{_PARTS.pattern})++")
_BLANK_BEFORE_BLANK = re.compile(r"\s |\0")
_CUTS = re.compile(r"(?<=\S)(?= )")


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Memo(dict):
    def __init__(self, encode, before: dict[str, bytes]):
        self.encode, self.before = encode, before

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.encode(word)
        self[word] = ids
        return ids


class ByteBpe:
    """A ``tokenizers`` file; ``encode`` gives ids as little-endian 32-bit numbers, without added ids.

    The pre-tokens of the usual byte-level pattern hold a blank at their
    beginning only, so a text may be cut before every blank that follows a
    character other than white space, and equal parts have equal ids.  Texts
    that hold an added token's string, and files of another kind, go to the
    library as they are.
    """

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_buffer(file)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(file)
        before = spec.get("pre_tokenizer") or {}
        self.by_word = (
            spec.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex") is True
            and before.get("add_prefix_space") is False
            and spec["model"]["type"] == "BPE"
        )
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        self.letters = _byte_letters()
        self.memo = _Memo(self._word, {})

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        found = self.library.model.tokenize(part.encode().decode("latin-1").translate(self.letters))
        return pack(f"<{len(found)}I", *(t.id for t in found))

    def _word(self, word: str) -> bytes:
        if not _PLAIN.fullmatch(word):
            return self._whole(word)
        parts = _PARTS.findall(word)
        return self._part(word) if len(parts) == 1 else b"".join(map(self.memo.__getitem__, parts))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_word or any(a in text for a in self.added):
            return self._whole(text)
        if len(self.memo) > MEMO:
            self.memo.before = {}
            self.memo = _Memo(self._word, self.memo)
        parts = _CUTS.split(text) if _BLANK_BEFORE_BLANK.search(text) else text.replace(" ", "\0 ").split("\0")
        return b"".join(map(self.memo.__getitem__, parts))


@lru_cache(2)
def byte_bpe_of(file: bytes) -> ByteBpe:
    """One encoder per file and worker, so that its words are remembered over tasks."""
    return ByteBpe(file)
