"""Ids and token counts of whole texts, exactly as the tokenizer library gives them."""

from __future__ import annotations

import base64
import os
import re

import numpy as np

MEMORY = 96 * 2**20  # bytes of remembered words in one Python worker
PROBE = 8  # texts of a worker's first batch on which both libraries must agree

#: How the vocabulary of the rank file splits texts before any merge (fixed, part of the vocabulary).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# characters whose class has been the same in every Unicode version that the libraries may have been built with
_UNUSUAL = re.compile("[^\t\n\r -~¡-ȟͰ-ͷЀ-ҁ‐-‧‰-⁞€぀-ゖ一-龥가-힣]")

_ENCODERS: dict = {}


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class IdEncoder:
    """Ids as little-endian unsigned 32-bit integers.

    With ``ranks``, a rank file of the same vocabulary, ordinary texts go through the faster library for
    those; texts with a special token's string or an unusual character, and all without ``ranks``, through tokenizers.
    The first texts of each worker go through both, and a difference raises.
    """

    def __init__(self, path: str, ranks: str | None):
        self._tokenizer = _library(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
            self._fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})
        self._probed = False

    def _ordinary(self, text: str) -> bool:
        return not any(s in text for s in self._special) and _UNUSUAL.search(text) is None

    def _exact(self, texts: list[str]) -> list[bytes]:
        encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, "<u4").tobytes() for e in encoded]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self._fast is None:
            return self._exact(texts)
        out = [
            np.asarray(self._fast.encode_ordinary(t), "<u4").tobytes() if self._ordinary(t) else None for t in texts
        ]
        odd = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(odd, self._exact([texts[i] for i in odd]) if odd else ()):
            out[i] = ids
        if not self._probed and texts:
            if self._exact(texts[:PROBE]) != out[:PROBE]:
                raise ValueError("the rank file is not the tokenizer's vocabulary")
            self._probed = True
        return out


class WordCounter:
    """Numbers of ids, for a vocabulary that drops white space: such texts may be counted word by word.

    Words repeat, so each worker remembers the counts of those it has seen, in bounded memory. Full stops and commas
    after letters are pieces of their own in such a vocabulary, and A-Z is lower-cased, so words are
    remembered without either.
    """

    _STOP = re.compile(r"(?<=[a-z])[.,](?= |\n|$)")

    def __init__(self, path: str):
        self._tokenizer = _library(path)
        self._words: dict[str, int] = {}
        self._room = MEMORY

    def _plain(self, text: str) -> str:
        if "<" in text:  # may be a special token's string, which is matched as it stands
            return text
        return self._STOP.sub(lambda m: " " + m[0], text.lower() if _UNUSUAL.search(text) is None else text)

    def encode(self, texts: list[str]) -> list[int]:
        if self._room < 0:
            self._words, self._room = {}, MEMORY
        split = [self._plain(t).replace("\n", " ").split(" ") for t in texts]
        new: set[str] = set()
        for words in split:
            new.update(words)
        new.difference_update(self._words)
        learn = list(new)
        for word, e in zip(learn, self._tokenizer.encode_batch_fast(learn, add_special_tokens=False)):
            self._words[word] = len(e)
            self._room -= len(word.encode()) + 160
        known = self._words.__getitem__
        return [sum(map(known, words)) for words in split]


def encoder(path: str, ranks: str | None = None) -> IdEncoder:
    """One for each vocabulary and worker process."""
    key = ("ids", path, ranks)
    if key not in _ENCODERS:
        _ENCODERS[key] = IdEncoder(path, ranks)
    return _ENCODERS[key]


def counter(path: str, blanks_matter: bool):
    """Like ``encoder``, for numbers of ids."""
    key = ("count", path, blanks_matter)
    if key not in _ENCODERS:
        _ENCODERS[key] = _LibraryCounter(path) if blanks_matter else WordCounter(path)
    return _ENCODERS[key]


class _LibraryCounter:
    def __init__(self, path: str):
        self._tokenizer = _library(path)

    def encode(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
