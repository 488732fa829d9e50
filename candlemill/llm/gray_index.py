"""A hierarchical index over 64-bit codes in Gray order.

Neighbours in the order of Gray ranks differ in few bits, so a run of codes shares many of them. Those
shared bits are held once, in the node above the run, as two masks: ``ones`` (set in every code below)
and ``some`` (set in any). Two nodes differ for certain in the bits that are set in all of one and in
none of the other. On the way down only bits that no upper pair of nodes has counted are added.
"""

from __future__ import annotations

import numpy as np

FAN = 8
PAIRS = 1 << 18
"""Pairs of nodes looked at together; larger sets are taken in slices."""


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of a code in the Gray sequence: the prefix sums, modulo two, of its bits."""
    rank = codes.copy()
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(step)
    return rank


class Index:
    """Levels over sorted codes, codes first; each level above has one node per ``FAN`` below."""

    def __init__(self, codes: np.ndarray):
        self.ones, self.some = [codes], [codes]
        while len(self.ones[-1]) > FAN:
            starts = np.arange(0, len(self.ones[-1]), FAN)
            self.ones.append(np.bitwise_and.reduceat(self.ones[-1], starts))
            self.some.append(np.bitwise_or.reduceat(self.some[-1], starts))

    def size(self, level: int) -> int:
        return len(self.ones[level])


def within(left: Index, right: Index, most: int, same: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all codes that differ in at most ``most`` bits; one of each pair if ``same``."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    level_a, level_b = len(left.ones) - 1, len(right.ones) - 1
    a = np.repeat(np.arange(left.size(level_a)), right.size(level_b))
    b = np.tile(np.arange(right.size(level_b)), left.size(level_a))
    none = np.zeros(len(a), np.uint64)
    open_ = [(level_a, level_b, a, b, none, np.zeros(len(a), np.int64))]
    while open_:
        level_a, level_b, a, b, counted, apart = open_.pop()
        if len(a) > PAIRS:
            for start in range(0, len(a), PAIRS):
                cut = slice(start, start + PAIRS)
                open_.append((level_a, level_b, a[cut], b[cut], counted[cut], apart[cut]))
            continue
        ones_a, some_a = left.ones[level_a][a], left.some[level_a][a]
        ones_b, some_b = right.ones[level_b][b], right.some[level_b][b]
        certain = (ones_a & ~some_b) | (ones_b & ~some_a)
        apart = apart + np.bitwise_count(certain & ~counted)
        keep = apart <= most
        if same and level_a == level_b:
            keep &= a < b if level_a == 0 else a <= b
        a, b, counted, apart = a[keep], b[keep], certain[keep], apart[keep]
        if not len(a):
            continue
        if level_a == level_b == 0:
            found.append((a, b))
        elif level_a >= level_b:
            above, below = _opened(a, left.size(level_a - 1))
            open_.append((level_a - 1, level_b, below, b[above], counted[above], apart[above]))
        else:
            above, below = _opened(b, right.size(level_b - 1))
            open_.append((level_a, level_b - 1, a[above], below, counted[above], apart[above]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def _opened(nodes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place in nodes, child) for all children."""
    below = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
    above = np.repeat(np.arange(len(nodes)), FAN)
    there = below < size
    return above[there], below[there]


def stars(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same places as (a, b): each place with the least one of its component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label[a] == label[b]).all():
            break
    while (label[label] != label).any():
        label = label[label]
    at = np.flatnonzero(label != np.arange(n))
    return label[at], at
