"""Token ids of whole texts through a public tokenizer, with each word encoded once.

The supported vocabularies encode every word of their pre-tokenizer on its own, so a bounded
dictionary of words seen gives the same ids as the library on the whole text, several times as fast.
Words are cut here only in texts of plain characters, where both regular expression engines agree;
any other text, one that holds an added token such as an end mark, and any tokenizer of another
build, goes to the library whole. What such a token in a text becomes is thus the library's answer.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from itertools import islice

import numpy as np
from tokenizers import Tokenizer

#: Words kept in a process; the dictionary starts anew beyond it, which costs time only.
WORDS_KEPT = 500_000
#: Byte-level vocabularies write a byte as a printable character: itself, or one from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARACTERS = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_SPACE = _BYTE_CHARACTERS[32]
_LONG = 1_000_000
#: Anything but characters whose class, case and normal form are the same everywhere.
_UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ȹɀ-ɏ]")
# Fixed patterns of the two public pre-tokenizers, and the same for plain characters.
_PATTERNS = {
    "byte_level": r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+",
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+": r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+",
}


class _Words(dict):
    """Ids of words by the vocabulary's own model, made when a word is first asked for."""

    def __init__(self, model):
        super().__init__()
        self.tokenize = model.tokenize

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS_KEPT:
            self.clear()
        rest = word[1:]
        if word[0] == " " and rest.isascii() and rest.isprintable() and " " not in rest:
            shown = _SPACE + rest
        elif word.isascii() and word.isprintable() and " " not in word:
            shown = word
        else:
            shown = word.encode().decode("latin-1").translate(_BYTE_CHARACTERS)
        ids = [t.id for t in self.tokenize(shown)]
        self[word] = found = struct.pack(f"<{len(ids)}I", *ids)
        return found


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids, as the library does without adding
    special tokens."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.vocabulary = self.library.get_vocab_size()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.lower = spec["normalizer"] is not None
        self.pattern = self._pattern(spec)
        added = [t["content"] for t in spec.get("added_tokens") or []]
        self.added = sorted(set(added + [a.lower() for a in added])) if self.lower else added
        self.words = _Words(self.library.model)

    @staticmethod
    def _pattern(spec: dict) -> re.Pattern | None:
        pre, model, norm = spec["pre_tokenizer"] or {}, spec["model"], spec["normalizer"]
        if model["type"] != "BPE" or model.get("dropout"):
            return None
        if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and norm is None:
            return re.compile(_PATTERNS["byte_level"])
        steps = pre.get("pretokenizers", [])
        names = [x["type"] for x in (norm or {}).get("normalizers", [])]
        if [x["type"] for x in steps] == ["Split", "ByteLevel"] and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"] and names == ["NFC", "Replace", "Lowercase"]:
            known = _PATTERNS.get(steps[0]["pattern"].get("Regex"))
            return re.compile(known) if known else None
        return None

    def _one(self, text: str) -> bytes:
        if not text:
            return b""
        plain = self.pattern is not None and not _UNUSUAL.search(text)
        if not plain or any(mark in form for form in ((text, text.lower()) if self.lower else (text,)) for mark in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self.lower:
            text = unicodedata.normalize("NFC", text).lower()
        ids = self.words.__getitem__
        if len(text) < _LONG:
            return b"".join(map(ids, self.pattern.findall(text)))
        found, pieces = self.pattern.finditer(text), []
        while some := [m.group() for m in islice(found, 100_000)]:
            pieces.append(b"".join(map(ids, some)))
        return b"".join(pieces)

    def encode(self, texts: list[str | None]):
        """The ids of each text in turn; null counts as empty."""
        return map(self._one, (t if isinstance(t, str) else "" for t in texts))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This process's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def public_path(name: str) -> str:
    """Where the installed collection of public tokenizers keeps a file."""
    import public_tokenizers

    return public_tokenizers.path(name)
