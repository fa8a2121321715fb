"""Minimal perfect hash of a set of keys, built and queried with numpy.

Level by level, keys hash into a bit field of twice their number; a key alone
on its bit stays there, the others go on to the next level. A key's slot is
the number of bits set before its own, so n keys get the slots 0 to n - 1, at
about three bits a key. An unknown key gets some slot or none: the caller
compares the fingerprint stored there.
"""

from __future__ import annotations

import io

import numpy as np
import xxhash

from tierflow.llm.words import mix

_GAMMA = 2
_STEP = 0xD6E8FEB86659FD93


def key_hashes(keys: list[str], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Position hash (64 bits) and independent fingerprint (32 bits) of keys."""
    both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(k.encode("utf-8", "surrogatepass"), seed) for k in keys), "<u8").reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].astype(np.uint32)


def _spot(h: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(h + np.uint64((level + 1) * _STEP % (1 << 64))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """``sizes``: bits of each level; ``bits``: all levels, one after another;
    ``before``: set bits before each 64-bit word."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.at = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        counts = np.bitwise_count(bits).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    @classmethod
    def build(cls, h: np.ndarray) -> "PerfectHash":
        """Of distinct 64-bit hashes; ValueError if two are equal."""
        if len(np.unique(h)) != len(h):
            raise ValueError("two keys have one hash")
        sizes, fields = [], []
        while len(h):
            size = -(-max(64, _GAMMA * len(h)) // 64) * 64
            spot = _spot(h, len(sizes), size)
            alone = np.bincount(spot, minlength=size) == 1
            sizes.append(size)
            fields.append(np.packbits(alone, bitorder="little").view("<u8"))
            h = h[~alone[spot]]
        return cls(np.array(sizes, np.int64), np.concatenate(fields) if fields else np.zeros(0, "<u8"))

    def slots(self, h: np.ndarray) -> np.ndarray:
        """Slot of every hash, -1 where none has it."""
        out = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            bit = self.at[level] + _spot(h[left], level, size)
            word, low = bit >> 6, (bit & 63).astype(np.uint64)
            hit = (self.bits[word] >> low & np.uint64(1)).astype(bool)
            below = np.bitwise_count(self.bits[word] & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
            out[left[hit]] = (self.before[word] + below)[hit]
            left = left[~hit]
        return out


class KeyIndex:
    """Keys with a stored fingerprint and integer columns, by perfect hash."""

    def __init__(self, seed: int, hash_: PerfectHash, fingerprint: np.ndarray, columns: dict[str, np.ndarray]):
        self.seed, self.hash, self.fingerprint, self.columns = seed, hash_, fingerprint, columns

    @classmethod
    def build(cls, keys: list[str], columns: dict[str, np.ndarray]) -> "KeyIndex":
        """``keys`` must differ; another seed is taken if two hashes meet."""
        if len(set(keys)) != len(keys):
            raise ValueError("keys repeat")
        for seed in range(64):
            h, fp = key_hashes(keys, seed)
            try:
                ph = PerfectHash.build(h)
                break
            except ValueError:
                continue
        else:
            raise ValueError("no seed separates the keys")
        order = np.empty(len(keys), np.int64)
        order[ph.slots(h)] = np.arange(len(keys))
        return cls(seed, ph, fp[order], {k: np.asarray(v)[order] for k, v in columns.items()})

    def find(self, keys: list[str]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Whether each key is there (by its fingerprint), and its columns."""
        h, fp = key_hashes(keys, self.seed)
        if not len(self.fingerprint):
            return np.zeros(len(keys), bool), {k: np.zeros(len(keys), v.dtype) for k, v in self.columns.items()}
        slot = self.hash.slots(h)
        there = (slot >= 0) & (self.fingerprint[slot] == fp)
        return there, {k: v[slot] for k, v in self.columns.items()}

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, seed=self.seed, sizes=self.hash.sizes, bits=self.hash.bits, fingerprint=self.fingerprint,
                 **{f"c_{k}": v for k, v in self.columns.items()})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> "KeyIndex":
        z = np.load(io.BytesIO(raw))
        return cls(int(z["seed"]), PerfectHash(z["sizes"], z["bits"]), z["fingerprint"],
                   {k[2:]: z[k] for k in z.files if k.startswith("c_")})
