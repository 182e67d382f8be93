"""Suffixes of a batch of contents: their order, what they share, and nearest smaller places, as arrays.

All lengths are cut at ``depth``, the width of the windows that are looked for:
a suffix is the start of a window, and what lies beyond that window belongs to
the next ones.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


def doubled(symbols: np.ndarray, depth: int, known: int = 1) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
    """Ranks of all suffixes by their first ``known``, 2 ``known``, ... symbols, and those by their first ``depth``.

    ``symbols`` order them by the first ``known``. Places with fewer symbols
    behind them have no rank.
    """
    levels, rank = [(known, symbols)], symbols
    while known < depth:
        step = min(known, depth - known)
        pair = rank[: max(len(rank) - step, 0)].astype(np.uint64) << np.uint64(32) | rank[step:].astype(np.uint64)
        rank = np.unique(pair, return_inverse=True)[1]
        known += step
        if step == known - step:
            levels.append((known, rank))
    return levels, rank


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each of different values, where the nearest smaller one before it stands; -1 if there is none.

    Everything between an entry and its candidate is larger than the entry; a
    candidate that is larger too is replaced by its own candidate.
    """
    found = np.arange(-1, len(values) - 1)
    open_ = np.flatnonzero(found >= 0)
    while len(open_):
        open_ = open_[values[found[open_]] > values[open_]]
        found[open_] = found[found[open_]]
        open_ = open_[found[open_] >= 0]
    return found


@dataclass(frozen=True)
class Suffixes:
    """The windows of some contents that stand one after the other in the order of their texts.

    ``at``: where each window starts in the joined contents; ``first``: each
    content's first window, and the end; ``order``: windows sorted by their
    symbols, equal ones by place.
    """

    depth: int
    levels: list[tuple[int, np.ndarray]]
    at: np.ndarray
    first: np.ndarray
    order: np.ndarray

    @classmethod
    def build(cls, levels: list[tuple[int, np.ndarray]], rank: np.ndarray, sizes: Sequence[int], depth: int) -> Suffixes:
        starts = np.cumsum([0, *sizes])
        counts = np.maximum(np.array(sizes, np.int64) - depth + 1, 0)
        first = np.concatenate(([0], np.cumsum(counts)))
        at = np.repeat(starts[:-1] - first[:-1], counts) + np.arange(first[-1])
        return cls(depth, levels, at, first, np.argsort(rank[at], kind="stable"))

    def shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols the windows ``a`` and ``b`` have in common from their starts, pair by pair."""
        i, j = self.at[a], self.at[b]
        out = np.zeros(len(i), np.int64)
        for length, rank in sorted(self.levels, key=lambda level: -level[0]):
            fits = np.flatnonzero(out + length <= self.depth)
            more = fits[rank[i[fits] + out[fits]] == rank[j[fits] + out[fits]]]
            out[more] += length
        return out
