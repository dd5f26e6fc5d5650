"""A hierarchical index over bit fingerprints in Gray order, for Hamming range search.

After Tang, Yu, Aref, Malluhi and Ouzzani, "Efficient Processing of Hamming-Distance-Based
Similarity-Search Queries Over MapReduce" (EDBT 2015). Fingerprints are sorted by their rank
in the Gray code, so that neighbours differ in few bits. A leaf holds a run of neighbours and
the masked bit pattern that all of them share; an upper node holds what its nodes share. A
query sums up the bits by which it differs from the patterns on its way down, each bit once,
and leaves a whole group as soon as the sum is beyond what any member allows.

One forest holds the trees of many blocks; all of them are searched level by level at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FAN = 8
#: Pairs of query and node that are looked at in one step.
FRONTIER = 500_000
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Position of each 64-bit code in the Gray order."""
    rank = code.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut every range into runs of FAN: bounds of the runs."""
    per = -(-(ends - starts) // FAN)
    first = np.repeat(starts, per)
    step = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    low = first + step * FAN
    return low, np.minimum(low + FAN, np.repeat(ends, per))


class GrayForest:
    """Trees over the blocks of sorted records.

    ``block`` must be sorted; within a block records must be sorted by (lead, Gray rank) for
    good groups. A pair of records x, y of one block is found if

        Hamming(code x, code y) <= (size x + size y) div ``divisor`` - lead x - lead y

    and the smaller size is at least ``ratio`` (a, b: a * small >= b * large) of the larger.
    """

    def __init__(self, block: np.ndarray, code: np.ndarray, size: np.ndarray, lead: np.ndarray, divisor: int, ratio: tuple[int, int]) -> None:
        self.code, self.size, self.lead, self.divisor, self.ratio = code, size.astype(np.int64), lead.astype(np.int64), divisor, ratio
        n = len(block)
        edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if n else np.empty(0, np.int64)
        starts, ends = edge, np.r_[edge[1:], n] if n else edge
        self.root_of = np.repeat(np.arange(len(starts)), ends - starts)
        ones, some = code, code
        least, most, lead_low, last = self.size, self.size, self.lead, np.arange(n)
        self.levels: list[tuple] = []  # from the leaves up: child bounds, shared mask, pattern, bounds of size and lead, last record
        while True:
            low, high = _runs(starts, ends)
            if len(low):
                ones, some = np.bitwise_and.reduceat(ones, low), np.bitwise_or.reduceat(some, low)
                least, most = np.minimum.reduceat(least, low), np.maximum.reduceat(most, low)
                lead_low, last = np.minimum.reduceat(lead_low, low), last[high - 1]
            self.levels.append((low, high, ~(ones ^ some), ones, least, most, lead_low, last))
            per = -(-(ends - starts) // FAN)
            ends = np.cumsum(per)
            starts = ends - per
            if not len(per) or per.max() == 1:
                break

    def _fits(self, q: np.ndarray, least: np.ndarray, most: np.ndarray, lead: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """Whether a group with these bounds may still hold a partner of q."""
        a, b = self.ratio
        s = self.size[q]
        return (apart <= (s + most) // self.divisor - self.lead[q] - lead) & (a * most >= b * s) & (a * s >= b * least)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of record positions x < y, in parts."""
        n = len(self.code)
        for begin in range(0, n, FRONTIER // FAN):
            q = np.arange(begin, min(n, begin + FRONTIER // FAN))
            yield from self._down(len(self.levels) - 1, q, self.root_of[q], np.zeros(len(q), np.int64), np.zeros(len(q), np.uint64))

    def _down(self, level: int, q: np.ndarray, node: np.ndarray, apart: np.ndarray, known: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        low, high, mask, pattern, least, most, lead, last = self.levels[level]
        new = mask[node] & ~known
        apart = apart + np.bitwise_count((self.code[q] ^ pattern[node]) & new)
        stay = (last[node] > q) & self._fits(q, least[node], most[node], lead[node], apart)
        q, node, apart = q[stay], node[stay], apart[stay]
        width = high[node] - low[node]
        ends = np.cumsum(width)
        at = 0
        while at < len(q):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + FRONTIER, "right")))
            part, w = slice(at, upto), width[at:upto]
            child = np.repeat(low[node[part]] - (np.cumsum(w) - w), w) + np.arange(w.sum())
            qs, ds, seen = np.repeat(q[part], w), np.repeat(apart[part], w), np.repeat(mask[node[part]], w)
            if level:
                yield from self._down(level - 1, qs, child, ds, seen)
            else:
                ds = ds + np.bitwise_count((self.code[qs] ^ self.code[child]) & ~seen)
                hit = (child > qs) & self._fits(qs, self.size[child], self.size[child], self.lead[child], ds)
                if hit.any():
                    yield qs[hit], child[hit]
            at = upto
