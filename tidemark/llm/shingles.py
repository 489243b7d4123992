"""Word shingles of whole texts as 64-bit hashes, by array arithmetic inside tasks."""

from __future__ import annotations

import numpy as np

_GAPS = bytes([9, 10, 11, 12, 13, 32])
_rng = np.random.default_rng(20240607)
#: One random odd value per byte, and powers of an odd base with their inverses, grown on demand.
_VALUE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[list(_GAPS)] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; kept and grown by doubling."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.ones(1, np.uint64) if known is None else known
        while len(known) < n:
            known = np.concatenate([known, known * np.uint64(pow(base, len(known), 1 << 64))])
        if n <= 1 << 22:  # longer texts do without a lasting table
            _powers[base] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def word_hashes(raw: bytes) -> np.ndarray:
    """A hash per word of a byte text; words are runs outside ASCII white space."""
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    gap = np.ones(len(data) + 2, bool)
    np.take(_SPACE, data, out=gap[1:-1])
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * powers(_BASE, len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(_INVERSE, len(data))[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Ascending distinct hashes of the runs of ``size`` words of the text with A-Z lowered; fewer words make one run."""
    words = word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
    n = min(size, len(words))
    if not n:
        return words
    total = words[:len(words) - n + 1]
    for k in range(1, n):
        total = total * np.uint64(0xC2B2AE3D27D4EB4F) + words[k:len(words) - n + 1 + k]
    return np.unique(mix(total + np.uint64(n)))
