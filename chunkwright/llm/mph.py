"""A minimal perfect hash over integer keys, with fingerprints that reject foreign keys.

Keys are placed level by level: at each level a key hashes to a bit, keys alone on their bit
stay, the others go on to the next, smaller level.  The rank of a key's bit among all set bits
is its slot, so ``n`` keys fill slots ``0 .. n - 1`` without gaps and no key is stored.
"""

from __future__ import annotations

import numpy as np

LEVELS = 48
BITS_PER_KEY = 2
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def key_hash(keys: np.ndarray, parts: np.ndarray, seed: int) -> np.ndarray:
    """Hash of ``(key, part)`` under a seed."""
    with np.errstate(over="ignore"):
        inner = mix(parts.astype(np.uint64) + _U(0x9E3779B97F4A7C15) * _U(seed + 1))
        return mix(keys.astype(np.int64).view(np.uint64) ^ inner)


def _bit(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(hashes + _U(0xD1B54A32D192ED03) * _U(level + 1)) % _U(size)).astype(np.int64)


class PerfectHash:
    """Slots of a fixed key set: ``levels`` are bit arrays, ``seed`` the seed that separated all keys."""

    def __init__(self, seed: int, sizes: list[int], bits: np.ndarray):
        self.seed, self.sizes, self.bits = seed, sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, parts: np.ndarray) -> PerfectHash:
        for seed in range(16):
            left, sizes, levels = key_hash(keys, parts, seed), [], []
            while len(left) and len(sizes) < LEVELS:
                size = max(64, BITS_PER_KEY * len(left))
                at = _bit(left, len(sizes), size)
                alone = np.bincount(at, minlength=size) == 1
                sizes.append(size)
                levels.append(alone)
                left = left[~alone[at]]
            if not len(left):
                return cls(seed, sizes, np.concatenate(levels) if levels else np.zeros(0, bool))
        raise ValueError("keys are not distinct")

    def slots(self, keys: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot (-1: certainly absent) and fingerprint of each key."""
        hashes = key_hash(keys, parts, self.seed)
        slot = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for level, size in enumerate(self.sizes):
            at = self.starts[level] + _bit(hashes[open_], level, size)
            hit = self.bits[at]
            slot[open_[hit]] = self.rank[at[hit]]
            open_ = open_[~hit]
        return slot, (mix(hashes ^ _U(0xA0761D6478BD642F)) >> _U(32)).astype(np.uint32)
