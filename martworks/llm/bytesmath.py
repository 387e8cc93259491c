"""Vectorised hashing of byte strings: rolling window hashes, words, sliding minima."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
U = np.uint64


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _INVERSE):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 at least of the base and of its inverse, mod 2^64."""
    return _powers(1 << max(20, (n - 1).bit_length()))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(29))) * U(0xA0761D6478BD642F)
    return h ^ (h >> U(32))


def prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums of (byte + 1) * base^position; hashes of slices follow from two entries."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + U(1)) * up[:len(data)], out=out[1:])
    return out


def slices(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:stop], equal for equal bytes wherever they stand."""
    _, down = powers(len(sums))
    return mix((sums[stop] - sums[start]) * down[start] ^ mix((stop - start).astype(np.uint64)))


def windows(sums: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of `width` bytes."""
    n = len(sums) - width
    _, down = powers(len(sums))
    return mix((sums[width:] - sums[:n]) * down[:n])


def slide_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours, by doubling."""
    k = 1
    while k * 2 <= width:
        values = np.minimum(values[:-k], values[k:])
        k *= 2
    return np.minimum(values[:len(values) - (width - k)], values[width - k:]) if k < width else values


_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def words(text: str) -> np.ndarray:
    """Hashes of the words of a text in order: runs of letters, digits and non-ASCII bytes, in lower case."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    inside = np.concatenate([[False], _WORD[data], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    if not len(edge):
        return np.empty(0, np.uint64)
    return slices(prefix(data), edge[::2], edge[1::2])


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of n neighbouring words; of all words if there are fewer."""
    if not len(hashes):
        return hashes
    n = min(n, len(hashes))
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = mix(out * U(0x9FB21C651E98DF25) + hashes[i:len(hashes) - n + 1 + i])
    return np.unique(out)
