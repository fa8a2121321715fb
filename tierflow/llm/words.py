"""Vectorised text analysis: words, hashes and n-grams of a piece of texts as
numpy arrays, without a Python loop over words."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLES: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = np.array(h, dtype=np.uint64)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_KINDS = {"word": lambda c: c.isalnum() or c == "_", "letter": str.isalpha, "upper": str.isupper,
          "space": str.isspace, "digit": str.isdigit}


def table(name: str) -> np.ndarray:
    """Per code point (0 to 65535) whether it is a word character, letter ..."""
    if name not in _TABLES:
        _TABLES[name] = np.array([_KINDS[name](chr(i)) for i in range(65536)])
    return _TABLES[name]


def powers(n: int) -> np.ndarray:
    have = _TABLES.get("powers")
    if have is None or len(have) < n:
        size = max(n, 256)
        have = np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE)])
        np.multiply.accumulate(have, out=have)
        _TABLES["powers"] = have
    return have


class Piece:
    """Code points and words of some texts.

    ``cp``: code points of all texts, each followed by a zero.
    ``doc_at``: where each text begins in ``cp`` (one more entry at the end).
    ``start``, ``length``, ``doc``: of each word (a longest run of letters,
    digits and underscores), in order.
    """

    def __init__(self, texts: list[str], lower: bool = True):
        if lower:
            texts = [t.lower() for t in texts]
        joined = "\0".join(texts) + "\0"
        self.n = len(texts)
        self.cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, self.n)
        self.doc_at = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        self.split(self.member("word"))

    def member(self, name: str) -> np.ndarray:
        out = table(name)[np.minimum(self.cp, 65535)]
        far = np.flatnonzero(self.cp > 65535)  # few: asked one by one, each kind once
        if len(far):
            kinds, at = np.unique(self.cp[far], return_inverse=True)
            out[far] = np.array([_KINDS[name](chr(c)) for c in kinds.tolist()])[at]
        return out

    def split(self, inside: np.ndarray) -> None:
        edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        self.start, end = edge[0::2], edge[1::2]
        self.length = end - self.start
        self.doc = np.searchsorted(self.doc_at, self.start, side="right") - 1
        self.inside = inside

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        first = np.cumsum(self.length) - self.length
        pos = np.arange(int(self.length.sum())) - np.repeat(first, self.length)
        c = (self.cp[self.inside].astype(np.uint64) + np.uint64(1)) * powers(int(self.length.max()) + 1)[pos]
        return mix(np.add.reduceat(c, first))

    def prefixes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the words longer than ``n`` and hashes of their first
        ``n`` characters."""
        at = np.flatnonzero(self.length > n)
        h = np.zeros(len(at), np.uint64)
        p = powers(n)
        for k in range(n):
            h += (self.cp[self.start[at] + k].astype(np.uint64) + np.uint64(1)) * p[k]
        return at, mix(h + powers(2)[1] * np.uint64(1) ^ np.uint64(n))

    def words_per_doc(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n)


def sequences(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive entries (len(h) - n + 1 of them)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    p, out = powers(n + 1), np.zeros(m, np.uint64)
    for k in range(n):
        out += h[k:k + m] * p[k + 1]
    return mix(out)
