"""Word hashes of many texts at once, and hashes of runs of words, in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes that part words of letters and digits; every byte beyond ASCII is a letter.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


@lru_cache(maxsize=4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse modulo 2**64 to the powers 0 to 2**bits - 1."""
    out = []
    for base in (int(BASE), pow(int(BASE), -1, 1 << 64)):
        p = np.ones(1, np.uint64)
        for k in range(bits):
            p = np.concatenate([p, p * np.uint64(pow(base, 1 << k, 1 << 64))])
        out.append(p)
    return out[0], out[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread form of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def runs(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of values[first:last] for many first and last; equal runs at any places hash alike."""
    if not len(first):
        return np.zeros(0, np.uint64)
    up, down = _powers(max(1, int(len(values)).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)], dtype=np.uint64)])
    return mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))


def words_of(texts: list[bytes], between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts' words, parted by the bytes `between` (a line end among them): hashes (never zero), first bytes and ends in the joined texts, and the number
    of the first word of each text, one more at the end. Texts are joined with a line end after each."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    inner = ~between[data]
    edge = np.flatnonzero(inner[1:] != inner[:-1]) + 1
    edge = np.concatenate([[0], edge]) if len(inner) and inner[0] else edge
    first, last = edge[0::2], edge[1::2]
    sizes = last - first
    at = np.cumsum(sizes) - sizes
    if len(first):
        up, _ = _powers(max(1, int(sizes.max()).bit_length()))
        inside = np.arange(int(sizes.sum())) - np.repeat(at, sizes)
        hashes = mixed(np.add.reduceat((data[inner].astype(np.uint64) + np.uint64(1)) * up[inside], at))
    else:
        hashes = np.zeros(0, np.uint64)
    hashes[hashes == 0] = 1
    ends = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return hashes, first, last, np.searchsorted(first, ends)
