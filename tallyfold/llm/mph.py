"""Minimal perfect hashing of distinct 64-bit keys: n keys go to the places 0 to n - 1 without a gap, in some four bits a key.

A level is a bit array of twice the keys that are left; a key that no other key meets at its bit is placed there, the rest go on to the next level. A key's place is the number of
ones before its bit over all levels. Keys that weren't built with get any place or none, so whoever looks up compares the key that is kept at the place.
"""

from __future__ import annotations

import numpy as np

LEVELS = 64
_ONE = np.uint64(1)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 mixed bits of each key (uint64)."""
    h = keys + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def build(keys: np.ndarray) -> bytes:
    """The function of distinct keys (int64) as bytes."""
    left, words, sizes = keys.view(np.uint64), [], []
    for level in range(LEVELS):
        if not len(left):
            break
        size = -(-2 * len(left) // 64)
        at = (mixed(left, level) % np.uint64(64 * size)).astype(np.int64)
        alone = np.bincount(at, minlength=64 * size) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        sizes.append(size)
        left = left[~alone[at]]
    if len(left):
        raise ValueError("the keys aren't distinct")
    return np.array([len(sizes), *sizes], dtype="<u8").tobytes() + b"".join(w.tobytes() for w in words)


class Function:
    def __init__(self, raw: bytes):
        flat = np.frombuffer(raw, dtype="<u8")
        n = int(flat[0])
        self.sizes, self.words = flat[1 : n + 1].astype(np.int64), flat[n + 1 :]
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Each key's place, -1 where no level has it."""
        k, out, begin = keys.view(np.uint64), np.full(len(keys), -1, dtype=np.int64), 0
        waiting = np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            at = mixed(k[waiting], level) % np.uint64(64 * size)
            word, bit = begin + (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            here = self.words[word]
            found = (here >> bit & _ONE).astype(bool)
            below = np.bitwise_count(here & ((_ONE << bit) - _ONE)).astype(np.int64)
            out[waiting[found]] = (self.before[word] + below)[found]
            waiting, begin = waiting[~found], begin + size
        return out
