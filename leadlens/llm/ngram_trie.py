"""A shard of an n-gram trie in compact memory-mapped levels.

Level one holds the first words of the n-grams in sorted order. Each further level holds the successors of
all nodes above, node after node, and a monotone sequence of pointers says where those of each node begin.
A successor is stored relative to its context: its hash is added to the last value of the context before it,
so a level is one rising sequence, and a hash can be told only by someone who knows where its context begins.
The last level has one byte for each n-gram with its quantised smoothed probability. All sequences are
Elias-Fano coded: the low bits of each value are packed, the high bits are the gaps of a bit vector. A lookup
goes down level by level: the pointers give the part of the next level that belongs to the node found, the
value before that part gives the offset, and the next value at or after offset and hash is searched there.
"""
from __future__ import annotations

import os
import tempfile

import numpy as np

from .common import by_value

by_value(__name__)

CHUNK = 1 << 15               # values decoded at a time
ID_BITS = 40                  # of a successor's hash; collisions matter within one context only
ID_MASK = np.uint64((1 << ID_BITS) - 1)


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` low bits of each value, one after the other, chunks of values filling whole bytes."""
    out = []
    for at in range(0, len(values), CHUNK):
        v = values[at:at + CHUNK]
        bits = np.empty((len(v), width), dtype=np.uint8)
        for k in range(width):
            bits[:, k] = (v >> np.uint64(k)) & np.uint64(1)
        out.append(np.packbits(bits.ravel()))
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint8)


class EliasFano:
    """A sorted sequence of integers below ``2 ** top``; ``parts`` are its arrays, in memory or mapped."""

    def __init__(self, n: int, width: int, parts: list[np.ndarray]):
        self.n, self.width = n, width
        self.low, self.high, self.ones, self.first = parts

    @classmethod
    def build(cls, values: np.ndarray, top: int) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        width = max(0, top - max(n, 1).bit_length())
        gaps = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(gaps[-1]) + 1 if n else 0, dtype=bool)
        bits[gaps] = True
        return cls(n, width, [pack_bits(values, width), np.packbits(bits), gaps[::CHUNK].astype(np.int64),
                              values[::CHUNK]])

    def chunk(self, k: int) -> np.ndarray:
        """Values ``k * CHUNK`` to the next chunk."""
        at, m = k * CHUNK, min(CHUNK, self.n - k * CHUNK)
        begin = int(self.ones[k])
        end = int(self.ones[k + 1]) if k + 1 < len(self.ones) else 8 * len(self.high)
        bits = np.unpackbits(np.asarray(self.high[begin // 8:end // 8 + 1]))
        high = np.flatnonzero(bits[begin % 8:])[:m] + begin - at - np.arange(m)
        size = (CHUNK * self.width + 7) // 8
        low = np.unpackbits(np.asarray(self.low[k * size:(k + 1) * size]))[:m * self.width].reshape(m, self.width)
        out = high.astype(np.uint64) << np.uint64(self.width)
        for b in range(self.width):
            out |= low[:, b].astype(np.uint64) << np.uint64(b)
        return out

    def successors(self, sorted_queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and value of the first element at or after each query; place ``n`` where there is none."""
        place = np.full(len(sorted_queries), self.n, dtype=np.int64)
        value = np.zeros(len(sorted_queries), dtype=np.uint64)
        # queries from just after one chunk's first value up to the next one's are answered by that chunk or its end
        edges = np.searchsorted(sorted_queries, np.asarray(self.first), side="right")
        for k in range(len(self.first)):
            lo, hi = (0 if k == 0 else edges[k]), (edges[k + 1] if k + 1 < len(edges) else len(sorted_queries))
            if lo == hi:
                continue
            v = self.chunk(k)
            got = np.searchsorted(v, sorted_queries[lo:hi])
            inside = got < len(v)
            place[lo:hi] = np.where(inside | (k + 1 < len(edges)), k * CHUNK + got, self.n)
            value[lo:hi] = v[np.minimum(got, len(v) - 1)]
            if k + 1 < len(edges):
                value[lo:hi][~inside] = self.first[k + 1]
        return place, value

    def at(self, places: np.ndarray) -> np.ndarray:
        """Values at sorted places."""
        out = np.zeros(len(places), dtype=np.uint64)
        edges = np.searchsorted(places, np.arange(0, self.n + CHUNK, CHUNK))
        for k in range(len(edges) - 1):
            if edges[k] < edges[k + 1]:
                out[edges[k]:edges[k + 1]] = self.chunk(k)[places[edges[k]:edges[k + 1]] - k * CHUNK]
        return out


class Quantiser:
    """Logarithms from ``low`` to 0 in 255 equal steps; code 0 is no n-gram."""

    def __init__(self, low: float):
        self.low = low

    def encode(self, log10p: np.ndarray) -> np.ndarray:
        return (1 + np.clip(np.rint((1 - log10p / self.low) * 254), 0, 254)).astype(np.uint8)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return np.where(codes > 0, (1 - (codes.astype(float) - 1) / 254) * self.low, -np.inf)


def before(values: EliasFano, places: np.ndarray) -> np.ndarray:
    """The value before each place, 0 before the first."""
    known, of = np.unique(places, return_inverse=True)
    out = np.zeros(len(known), dtype=np.uint64)
    out[known > 0] = values.at(known[known > 0] - 1)
    return out[of]


class Trie:
    """Nodes, pointers and codes, mapped from one file that has no name any more once the trie is open."""

    def __init__(self, grams: list[np.ndarray], codes: np.ndarray):
        """``grams``: one array a level, together the n-grams, distinct and sorted; hashes below the first level are
        of ``ID_BITS`` bits, so that 2^24 contexts have room."""
        new, sequences, above = np.zeros(len(codes), dtype=bool), [], None
        new[:1] = True
        for level, g in enumerate(grams):
            new[1:] |= g[1:] != g[:-1]
            rows = np.flatnonzero(new)  # where each node of this level begins
            values = g[rows].astype(np.uint64)
            if level:
                if len(above) >> (64 - ID_BITS):
                    raise ValueError("too many contexts for one shard")
                starts = np.append(np.searchsorted(rows, above), len(rows))
                step = values[starts[1:] - 1] + np.uint64(1)
                offset = np.cumsum(step) - step
                values += np.repeat(offset, np.diff(starts)) + np.uint64(1)
                sequences.append(starts.astype(np.uint64))
            sequences.append(values)
            above = rows
        levels = [EliasFano.build(v, max(1, int(v[-1]).bit_length() if len(v) else 1)) for v in sequences]
        arrays = [a for x in levels for a in (x.low, x.high, x.ones, x.first)] + [codes]
        fd, path = tempfile.mkstemp(suffix=".trie")
        try:
            at = []
            with os.fdopen(fd, "wb") as f:
                for a in arrays:
                    at.append(f.tell())
                    f.write(a.tobytes())
            self.bytes = os.path.getsize(path)
            mapped = [np.memmap(path, dtype=a.dtype, mode="r", offset=o, shape=a.shape) if a.size else a
                      for a, o in zip(arrays, at)]
        finally:
            os.unlink(path)  # the maps keep the bytes; nothing stays behind when the task is killed
        self.sequences = [EliasFano(x.n, x.width, mapped[4 * i:4 * i + 4]) for i, x in enumerate(levels)]
        self.codes = mapped[-1]

    def lookup(self, grams: list[np.ndarray]) -> np.ndarray:
        """Codes of sorted n-grams, 0 where the trie has none."""
        out = np.zeros(len(grams[0]), dtype=np.uint8)
        first, of = np.unique(grams[0], return_inverse=True)
        place, value = self.sequences[0].successors(first)
        found = (place < self.sequences[0].n) & (value == first)
        alive = np.flatnonzero(found[of])
        node = place[of[alive]]
        for g, pointers, values in zip(grams[1:], self.sequences[1::2], self.sequences[2::2]):
            if not len(alive):
                break
            known, of = np.unique(node, return_inverse=True)
            begin, end = pointers.at(known).astype(np.int64), pointers.at(known + 1).astype(np.int64)
            key = before(values, begin)[of] + g[alive] + np.uint64(1)
            inside = key <= before(values, end)[of]  # beyond the context's last successor begins the next context
            alive, of, key = alive[inside], of[inside], key[inside]
            spot, got = values.successors(key)
            hit = (spot >= begin[of]) & (spot < end[of]) & (got == key)
            alive, node = alive[hit], spot[hit]
        out[alive] = self.codes[node]
        return out
