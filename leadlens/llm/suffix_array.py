"""Suffix arrays of one shard's bytes: Larsson-Sadakane refinement and Kasai common prefixes in numpy.

Both stop at ``limit`` bytes, the length of the repeats that are looked for.
"""
from __future__ import annotations

import numpy as np

from .common import by_value

by_value(__name__)


def words8(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian integer; zeros follow the end."""
    w = np.concatenate([buf, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    n = len(buf)
    for step in (1, 2, 4):
        w = (w[:len(w) - step] << np.uint64(8 * step)) | w[step:]
    return w[:n]


def regroup(new: np.ndarray, at: np.ndarray, sa: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Number the groups that start where ``new`` is set, among the suffix-array places ``at``, by their first
    place; what comes back are the places whose group still has more than one suffix."""
    first = at[np.flatnonzero(new)][np.cumsum(new) - 1]
    rank[sa[at]] = first
    alone = new & np.append(new[1:], True)
    return at[~alone]


def suffix_array(buf: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Suffixes in the order of their first ``depth`` bytes (``limit`` at least), the group of each suffix (those
    that share all these bytes are in one), the words of ``words8``, and ``depth``.

    The first order is by eight bytes. Then, as Larsson and Sadakane do, only groups that are still unsorted are
    sorted, by the ranks of what follows the bytes already compared, which doubles these with every round.
    """
    n, w = len(buf), words8(buf)
    sa = np.argsort(w, kind="stable").astype(np.int64)
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    ws = w[sa]
    left = regroup(np.append(True, ws[1:] != ws[:-1])[:n], np.arange(n), sa, rank)
    h = 8
    while h < limit and len(left):
        suffix = sa[left]
        group, follow = rank[suffix], rank[np.minimum(suffix + h, n)] + 1
        order = np.argsort(group * (n + 1) + follow, kind="stable")
        sa[left] = suffix[order]
        group, follow = group[order], follow[order]
        new = np.append(True, (group[1:] != group[:-1]) | (follow[1:] != follow[:-1]))
        left = regroup(new, left, sa, rank)
        h *= 2
    return sa, rank[:n], w, h


def common_prefixes(buf: np.ndarray, limit: int, stride: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array and the bytes, ``limit`` at most, that each suffix shares with the one before it.

    Kasai: a suffix shares at least one byte less than the suffix one place to its left in the text does. Every
    ``stride``-th place is compared from its start, all at a time, the others from the bound that this gives. The
    bound needs the true order, so a place whose suffix is in one group with the one before it gives none; all that
    is known of such a pair, and enough, is that it shares ``limit`` bytes.
    """
    sa, rank, w, depth = suffix_array(buf, limit)
    n = len(buf)
    w = np.concatenate([w, np.zeros(depth + 8, dtype=np.uint64)])
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    tied = (before >= 0) & (rank[before] == rank)
    shared = np.where(tied, depth, 0)

    def extend(at: np.ndarray, low: np.ndarray, most: int) -> None:
        open_ = (before[at] >= 0) & ~tied[at]
        at, got = at[open_], low[open_].copy()
        live = np.flatnonzero(got < most)
        while len(live):
            x = w[at[live] + got[live]] ^ w[before[at[live]] + got[live]]
            same = x == 0
            stop = live[~same]
            got[stop] += (x[~same].astype(">u8").view(np.uint8).reshape(-1, 8) != 0).argmax(axis=1)
            live = live[same]
            got[live] += 8
            live = live[got[live] < most]
        shared[at] = np.minimum(got, most)

    base = np.arange(0, n, stride)
    extend(base, np.zeros(len(base), dtype=np.int64), depth)
    rest = np.flatnonzero(np.arange(n) % stride)
    of_base = shared[rest - rest % stride]
    extend(rest, np.where(of_base < depth, np.clip(of_base - rest % stride, 0, limit), 0), limit)
    return sa, np.minimum(shared[sa], limit)
