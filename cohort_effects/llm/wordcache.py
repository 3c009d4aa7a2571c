"""Exact token ids of a public word-level BPE tokenizer, word by word.

The tokenizer encodes each pre-token by itself, so the ids of a text are the
ids of its pre-tokens.  Most pre-tokens repeat; their ids are kept in a bounded
cache and only new ones are encoded.  Texts outside printable Latin-1, or with
a special token's marker, go to the tokenizer whole.
"""

from __future__ import annotations

import re

import numpy as np

# The tokenizer's pre-token pattern, for lower-cased Latin-1.
_LETTERS = "a-zªµºß-öø-ÿ"
_NUMBERS = "0-9²³¹¼-¾"
_PRETOKEN = re.compile(rf"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_NUMBERS}]|[^\s{_LETTERS}{_NUMBERS}]+")
_PLAIN = re.compile(r"[\t\n\r -~¡-ÿ]*")
CACHE_WORDS = 600_000


class WordCache:
    """``encode`` gives ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        plain = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x100))]
        self.spelled = str.maketrans({c: split(c)[0][0] for c in plain})  # as the vocabulary spells bytes
        self.cache: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if "<|" in text or not _PLAIN.fullmatch(text):
            return self._whole(text)
        tokens = _PRETOKEN.findall(text.lower())
        try:
            return b"".join(map(self.cache.__getitem__, tokens))
        except KeyError:
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
            for token in {t for t in tokens if t not in self.cache}:
                ids = [t.id for t in self.model.tokenize(token.translate(self.spelled))]
                self.cache[token] = b"".join([i.to_bytes(4, "little") for i in ids])
            return b"".join(map(self.cache.__getitem__, tokens))


_loaded: dict[str, WordCache] = {}


def word_cache(path: str) -> WordCache:
    """One per worker process and tokenizer file."""
    if path not in _loaded:
        _loaded[path] = WordCache(path)
    return _loaded[path]
