"""An encoder that needs no model: hashed word counts as unit vectors."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np

REMEMBERED_WORDS = 1 << 16


class HashingEncoder:
    """Counts of lower-cased words in ``dim`` buckets (MD5), scaled to length 1.

    A text without words gives a zero vector.
    """

    def __init__(self, dim: int = 64):
        self.dim = dim
        self._seen: dict[str, int] = {}

    def __getstate__(self):
        return {"dim": self.dim, "_seen": {}}

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim))
        for row, text in zip(out, texts):
            for word, n in Counter(text.lower().split()).items():
                row[self._bucket(word)] += n
        length = np.sqrt((out ** 2).sum(axis=1, keepdims=True))
        return out / np.where(length == 0, 1.0, length)

    def _bucket(self, word: str) -> int:
        known = self._seen.get(word)
        if known is None:
            known = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % self.dim
            if len(self._seen) >= REMEMBERED_WORDS:
                self._seen.clear()
            self._seen[word] = known
        return known
