"""Binary fuse filters: static approximate sets of 64-bit keys.

Each key has three slots in three consecutive segments of an array of bytes,
and the bytes there xor to the key's fingerprint.  A lookup of a member is
always true; of another key it is true once in 256.  The array holds about
1.13 bytes a key (more for few keys).  Construction peels keys that own a
slot alone, all of a round at once, and fills the array in reverse.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

_U = np.uint64


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Keys spread over 64 bits (multiply-xorshift finaliser)."""
    with np.errstate(over="ignore"):
        h = keys.astype(_U) + _U(seed)
        h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


@dataclass
class Fuse:
    seed: int
    segment: int
    starts: int
    cells: np.ndarray

    def slots(self, h: np.ndarray) -> np.ndarray:
        first = ((h >> _U(32)) * _U(self.starts)) >> _U(32)
        mask = _U(self.segment - 1)
        second = (first + _U(self.segment)) ^ ((h >> _U(18)) & mask)
        third = (first + _U(2 * self.segment)) ^ (h & mask)
        return np.stack([first, second, third]).astype(np.int64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys) or not len(self.cells):
            return np.zeros(len(keys), bool)
        h = _mixed(keys, self.seed)
        a, b, c = self.slots(h)
        return self.cells[a] ^ self.cells[b] ^ self.cells[c] == _print(h)


def _print(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> _U(32))) & _U(255)).astype(np.uint8)


def build(keys: np.ndarray) -> Fuse:
    """The filter of ``keys`` (repeats count once)."""
    keys = np.unique(keys.astype(_U))
    n = len(keys)
    if not n:
        return Fuse(0, 1, 0, np.empty(0, np.uint8))
    segment = min(1 << 18, 1 << max(2, int(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    room = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    starts = max(1, math.ceil(room / segment) - 2) * segment
    for seed in range(1, 1000):
        fuse = Fuse(seed * 0x9E3779B97F4A7C15 % (1 << 64), segment, starts, np.zeros(starts + 2 * segment, np.uint8))
        h = _mixed(keys, fuse.seed)
        slots = fuse.slots(h)
        count = np.bincount(slots.ravel(), minlength=len(fuse.cells))
        # The xor of the numbers of a slot's keys: the key itself where one is left.
        which = np.zeros(len(fuse.cells), np.int64)
        for s in slots:
            np.bitwise_xor.at(which, s, np.arange(n))
        left, rounds = n, []
        while left:
            own = np.flatnonzero(count == 1)
            if not len(own):
                break
            key, pick = np.unique(which[own], return_index=True)
            rounds.append((key, own[pick]))
            for s in slots[:, key]:
                np.subtract.at(count, s, 1)
                np.bitwise_xor.at(which, s, key)
            left -= len(key)
        if left:
            continue  # keys that hold each other: another seed
        prints = _print(h)
        for key, at in reversed(rounds):
            fuse.cells[at] = 0
            a, b, c = fuse.cells[slots[:, key]]
            fuse.cells[at] = prints[key] ^ a ^ b ^ c
        return fuse
    raise RuntimeError("no seed separates the keys")
