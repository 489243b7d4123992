"""Content-defined anchors of byte texts, and the stretches of windows that hang on them."""

from __future__ import annotations

import numpy as np

from tidemark.llm.shingles import _VALUE, mix, powers

WINDOW = 200
GRAM = 48
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` bytes."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_VALUE[data] * powers(_BASE, len(data)), dtype=np.uint64)])
    return mix((sums[size:] - sums[:-size]) * powers(_INVERSE, len(data))[:len(data) - size + 1])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[:len(values) - (width - have)], values[width - have:]) if width > have else values


#: Low bits of a gram's value that tell neighbouring places apart; the rest is its hash.
_PLACE = 20


def stretches(data: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cut the windows of a text into stretches with one key each: (key, first window, last window, recurs).

    A window's key is the smallest hash of the runs of ``gram`` bytes inside it, so equal windows have equal keys
    wherever they stand. Neighbouring windows with the same key form one stretch; ``recurs`` says that its
    smallest run stands at several places, without which no two windows of the stretch can be equal.
    """
    if len(data) < window:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(bool)
    hashes = gram_hashes(data, gram)
    low = np.uint64((1 << _PLACE) - 1)
    least = sliding_least((hashes & ~low) | (np.arange(len(hashes), dtype=np.uint64) & low), window - gram + 1)
    keys = (least >> np.uint64(_PLACE)).astype(np.int64)
    new = keys[1:] != keys[:-1]
    first = np.concatenate([[0], np.flatnonzero(new) + 1])
    moved = np.concatenate([[False], (least[1:] != least[:-1]) & ~new])
    return keys[first], first, np.concatenate([first[1:] - 1, [len(keys) - 1]]), np.logical_or.reduceat(moved, first)
