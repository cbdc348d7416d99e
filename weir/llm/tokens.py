"""Token ids by a fixed public tokenizer, whole texts, with bounded per-word caches in each worker.

A tokenizer whose configuration drops white space and never lets a token span it gives the same ids for a text as
for its white-space separated words in turn. For such a tokenizer the ids of a word are looked up, so that common
words are encoded once or twice per worker; any other tokenizer encodes whole texts.
"""

from __future__ import annotations

import json
import re
import struct

import numpy as np
from tokenizers import Tokenizer

#: The normaliser and pre-tokenizer for which the per-word path is exact.
_LETTERS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_SPLIT = {"type": "Split", "pattern": {"Regex": _LETTERS}, "behavior": "Removed", "invert": True}

#: Latin-1 letters are single NFC code points with single-character lower case, so these words need no normaliser.
_SIMPLE = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]+").fullmatch
_MARKS = frozenset(b"!\"#$%&()*+,-./:;=?@[]^_`{}~")
_L = "a-zß-öø-ÿ"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[0-9]|[^0-9{_L}]+").findall

#: Byte-level BPE's rule: bytes that print stand for themselves, the others for the code points from 256 on, in order.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LEVEL = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTED)}

#: Words kept in each of the two generations of a worker's cache, and the longest such word in bytes.
CACHED_WORDS = 500_000
LONGEST_CACHED = 64


#: Packers of so many ids as little-endian unsigned 32-bit integers.
_PACKERS = [struct.Struct(f"<{n}I").pack for n in range(LONGEST_CACHED + 1)]


def _packed(ids: list[int]) -> bytes:
    return _PACKERS[len(ids)](*ids) if len(ids) < len(_PACKERS) else struct.pack(f"<{len(ids)}I", *ids)


class _Words(dict):
    """UTF-8 word -> its ids as little-endian unsigned 32-bit integers.

    A full cache becomes the old generation; words that are met again move to the new one.
    """

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.tokenize = tokenizer.model.tokenize
        self.old: dict[bytes, bytes] = {}
        self.marks = {m: _packed([t.id for t in self.tokenize(chr(m))]) for m in _MARKS}

    def _piece(self, piece: bytes) -> bytes:
        """Ids of one piece of a simple word in lower case; a piece is a word as well."""
        ids = self.get(piece) or self.old.get(piece)
        if ids is None:
            own = piece.decode() if piece.isascii() else piece.decode("latin-1").translate(_BYTE_LEVEL)
            ids = self[piece] = _packed([token.id for token in self.tokenize(own)])
        return ids

    def _other(self, word: bytes) -> bytes:
        text = word.decode()
        if _SIMPLE(text) and "<|" not in text:
            text = text.lower()
            if text.isalpha():
                return self._piece(text.encode())
            if text[:-1].isalpha() and text[-1].isascii() and ord(text[-1]) in self.marks:
                return self._piece(text[:-1].encode()) + self.marks[ord(text[-1])]
            return b"".join([self._piece(piece.encode()) for piece in _PIECES(text)])
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if len(word) > LONGEST_CACHED:
                return self._other(word)
            if word.isalpha():
                low = word.lower()
                ids = self._piece(low) if low != word else _packed([t.id for t in self.tokenize(word.decode())])
            elif word[-1] in self.marks and (core := word[:-1]).isalpha():
                ids = self._piece(core.lower()) + self.marks[word[-1]]
            else:
                ids = self._other(word)
        if len(self) >= CACHED_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Encoder:
    """Texts (UTF-8 bytes) to ids (little-endian unsigned 32-bit bytes), exactly as the tokenizers library gives them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_str(json.dumps(spec))
        parts = (spec.get("normalizer") or {}).get("normalizers")
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [None]
        own = all(
            not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) and t["content"].startswith("<|")
            for t in spec.get("added_tokens", [])
        )
        levels = [{"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
        by_word = own and splits[1:] == levels and parts == _NORMALIZERS and splits[0] == _SPLIT and not spec.get("truncation")
        self.words = _Words(self.tokenizer) if by_word else None

    def __call__(self, text: bytes) -> bytes:
        if self.words is not None:
            return b"".join(map(self.words.__getitem__, text.split()))
        ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; its caches outlive the task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_tokenizer() -> str:
    """Path of the public 49k word BPE vocabulary; every operator takes another path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
