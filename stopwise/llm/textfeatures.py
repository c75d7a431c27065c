"""Word hashing for the linear models: vectorised per Arrow batch, one pass over each whole text."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np

#: ASCII punctuation taken off both ends of a word.
_PUNCT = b".,;:!?\"'()[]{}*#$%&|<>/\\-_=+~`^@"
#: Words remembered by a task.
_MEMO = 150_000


class WordHasher:
    """32-bit hashes of words, remembered in a bounded table. stem: hash only so many first characters (0: whole words).

    A word is lower-cased (A-Z only) and stripped of ASCII punctuation at both ends, so `Word!!` and
    `word` are one; a word of punctuation alone stays as it is.
    """

    def __init__(self, stem: int = 0) -> None:
        self.stem = stem
        self.memo: dict[bytes, int] = {}

    def __call__(self, words: Sequence[bytes]) -> np.ndarray:
        memo = self.memo
        if len(memo) > _MEMO:
            memo.clear()
        for w in set(words).difference(memo):
            bare = w.strip(_PUNCT) or w
            if self.stem and len(bare) > self.stem:
                bare = bare.decode("utf-8", "replace")[: self.stem].encode()
            memo[w] = zlib.crc32(bare)
        return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def split_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mix(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of ordered pairs."""
    h = a * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)
    h ^= h >> np.uint64(29)
    h = (h + b) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def scatter(h: np.ndarray, bits: int) -> np.ndarray:
    """Bucket numbers from hashes."""
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)).astype(np.int64)
