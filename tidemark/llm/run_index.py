"""A run-length index over a collection of strings: Burrows-Wheeler runs with sampled ends, and what matches they prove.

Suffixes are ordered by their first ``depth`` bytes with rank doubling; only places with that many bytes left in
their string take part. The transform (the byte before each suffix, in suffix order) falls into runs, few in a
repetitive collection. The suffix array is kept at run ends only: a match between neighbours inside a run is the
continuation of a longer match one byte to the left, so following the matching statistics from the run ends
visits every maximal match once.
"""

from __future__ import annotations

import numpy as np


class RunIndex:
    """``strings`` joined without marks; no match reaches over a string's end."""

    def __init__(self, strings: list[bytes], depth: int):
        self.depth = depth
        self.text = np.frombuffer(b"".join(strings) + b"\0" * 16, np.uint8)
        lengths = np.array([len(s) for s in strings], np.int64)
        self.ends = np.cumsum(lengths)
        self.begins = self.ends - lengths
        spots = np.maximum(lengths - depth + 1, 0)
        self.owner = np.repeat(np.arange(len(strings)), spots)
        self.places = np.repeat(self.begins - (np.cumsum(spots) - spots), spots) + np.arange(spots.sum())
        self._sort()

    def _sort(self) -> None:
        n = len(self.text) - 16
        words = np.lib.stride_tricks.as_strided(self.text, (n + 1, 8), (1, 1))[:n].copy().view(">u8").ravel().astype(np.uint64)
        rank, have = _rank(words), 8
        while 2 * have <= self.depth:
            rank = _rank(_joined(rank, rank[np.minimum(np.arange(n) + have, n - 1)]))
            have *= 2
        self.rank, self.have = rank, have
        whole = _joined(rank[self.places], rank[self.places + self.depth - have])  # the two parts overlap or meet
        order = np.argsort(whole, kind="stable")  # suffixes equal that far stay in text order
        whole, self.suffixes = whole[order], self.places[order]
        equal = whole[1:] == whole[:-1]  # neighbours that share ``depth`` bytes
        owner = self.owner[order]
        before = np.where(self.suffixes > self.begins[owner], self.text[np.maximum(self.suffixes - 1, 0)].astype(np.int64), -1)
        # A run goes on where both bytes before agree and the suffixes from there are neighbours again; this last point
        # always holds in a full order and has to be asked in one of limited depth.
        spot = np.full(n + 1, -2, np.int64)
        spot[self.suffixes] = np.arange(len(order))
        back = spot[self.suffixes - 1]
        head = np.ones(len(order), bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] < 0) | (back[1:] != back[:-1] + 1)
        self.heads = np.flatnonzero(head)  # run starts; the run before ends one place earlier
        at = self.heads[self.heads > 0]
        at = at[equal[at - 1]]
        self.sampled = (self.suffixes[at - 1], self.suffixes[at], owner[at - 1], owner[at])

    @property
    def runs(self) -> int:
        return len(self.heads)

    def matches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal matches of at least ``depth`` bytes at run ends: (string, start inside it, length), both partners."""
        p, q, a, b = self.sampled
        room = np.minimum(self.ends[a] - p, self.ends[b] - q)
        length = np.full(len(p), self.depth, np.int64)
        alive = np.arange(len(p))
        while len(alive):  # whole ranked blocks first
            x = alive[length[alive] + self.have <= room[alive]]
            alive = x[self.rank[p[x] + length[x]] == self.rank[q[x] + length[x]]]
            length[alive] += self.have
        alive = np.arange(len(p))
        while len(alive):
            x = alive[length[alive] < room[alive]]
            alive = x[self.text[p[x] + length[x]] == self.text[q[x] + length[x]]]
            length[alive] += 1
        owner, place = np.concatenate([a, b]), np.concatenate([p, q])
        return owner, place - self.begins[owner], np.concatenate([length, length])


def _rank(values: np.ndarray) -> np.ndarray:
    """Dense ranks of values."""
    order = np.argsort(values)
    ordered = values[order]
    steps = np.zeros(len(values), np.uint64)
    np.cumsum(ordered[1:] != ordered[:-1], out=steps[1:])
    rank = np.empty(len(values), np.uint64)
    rank[order] = steps
    return rank


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first << np.uint64(32)) | second


def covered(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The union of intervals as maximal disjoint ones in order; those that touch are joined."""
    if not len(starts):
        return []
    order = np.lexsort((ends, starts))
    starts, far = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > far[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])
    return list(zip(starts[new].tolist(), far[last].tolist(), strict=True))
