"""SentencePiece encoding and decoding with sampled segmentations.

The lattice of a text has an arc for every vocabulary piece that fits; a piece of score rank ``r`` has
weight ``1 / (r + 2)`` (a BPE vocabulary gives an order of merges, not probabilities) and a segmentation
the product of its pieces' weights, divided by the sum over all. Characters that no piece covers go
through byte pieces. As no piece goes on past the start of a word, the lattice is a chain of words.

``samples`` distinct segmentations are drawn without replacement by Gumbel top-k: every segmentation has
its log-probability plus Gumbel noise, and the largest come first. A best-first search (A-star) over
prefixes finds them without listing the lattice: the exact bound of a set of completions is a Gumbel
variable at the log of the set's mass, drawn below the bound of the set that it was split from. The best
set is popped, a completion is drawn from it arc by arc, and the arcs passed by along the way join the
queue as sets of their own. The next bound left in the queue is the threshold ``kappa``, and
``1 - exp(-exp(log_prob - kappa))`` is the inclusion score of a sample. All noise is a hash of the seed, the row
key and the place, so results do not depend on how rows are dealt.

Each row is handled alone, so size and skew do not matter; the distinct words of a chunk of rows get their
lattices at once, and a text longer than ``chunk_chars`` is a chunk of its own. A task keeps the lattices of words that it
has met, up to ``word_chars`` characters, then begins anew; memory is bounded by both.

Edge cases: null and empty texts have one segmentation, without pieces; a text with fewer segmentations
than ``samples`` gives all it has, with inclusion score 1; rows that repeat the key and the text get equal
samples; a null key is a key of its own; an empty table gives an empty result. Decoding gives back the text exactly,
literal U+2581 included (it is spelt in bytes). Only key and text are read, other columns cannot clash.
"""
from __future__ import annotations

import heapq
import math
import re
from collections import defaultdict
from dataclasses import dataclass, field
from itertools import count, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_value, giving_back, small_batches

by_value(__name__)

SPACE = "\u2581"
LITERAL = "\ud800"            # stands for U+2581 in a text; no text holds a lone surrogate
UNIT = re.compile(rf"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")  # no piece crosses the end of one
SLOTS = 1 << 18
SOLVED_AT_ONCE = 2500       # words whose lattices are solved in one step
SPELT_AT_ONCE = 1 << 16      # ids that are decoded in one step
BYTE_WEIGHT = -12.0           # log-weight of a byte piece
STEP, UNIT_STEP, SAMPLE_STEP = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
MIX1, MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


@dataclass(frozen=True)
class PieceSampler:
    model: str = "/opt/tokenizers/piece_bpe_32k.model"
    samples: int = 2
    seed: int = 11
    chunk_chars: int = 150_000   # texts that are solved together; a row counts as 40 characters at least
    word_chars: int = 150_000    # words whose lattices are kept from chunk to chunk


@dataclass(frozen=True)
class Vocabulary:
    """All prefixes of the ordinary pieces by hash, with the id (-1: no piece) and log-weight of each; hash tables of
    their places (a prefix is in the first table whose slot was free); ids of the byte pieces; the bytes that each id
    stands for."""
    prefixes: np.ndarray
    slots: tuple
    piece: np.ndarray
    weight: np.ndarray
    byte_ids: tuple
    spelt: tuple

    def find(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes among the prefixes, -1 for others."""
        out = np.full(len(h), -1, dtype=np.int64)
        left = np.arange(len(h))
        for level, table in enumerate(self.slots):
            at = table[slot_of(h, level)]
            same = self.prefixes[at] == h
            hit = np.flatnonzero(same & (at >= 0))
            out[left[hit]] = at[hit]
            on = np.flatnonzero(~same & (at >= 0))  # a free slot means that there is no such prefix
            if not len(on):
                break
            left, h = left[on], h[on]
        return out


def slot_of(h: np.ndarray, level: int) -> np.ndarray:
    return ((h >> np.uint64(11 * level)) & np.uint64(SLOTS - 1)).view(np.int64)


def slot_tables(keys: np.ndarray) -> tuple:
    tables, left = [], np.arange(len(keys))
    while len(left):
        slot, first = np.unique(slot_of(keys[left], len(tables)), return_index=True)
        table = np.full(SLOTS, -1, dtype=np.int32)
        table[slot] = left[first]
        tables.append(table)
        left = np.delete(left, first)
    return tuple(tables)


def step_hash(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Hash of a string that is one character longer."""
    h = (h ^ code.astype(np.uint64)) * MIX1
    return h ^ (h >> np.uint64(29))


def load(model: str) -> Vocabulary:
    """Read on the driver; the vocabulary is of a fixed size and goes to the tasks with the code."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=model)
    found, byte_ids, spelt = {}, [0] * 256, []
    ranked = sorted((i for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i)
                                                                  or p.is_unused(i))), key=lambda i: (-p.get_score(i), i))
    for rank, i in enumerate(ranked):
        piece = p.id_to_piece(i)
        if SPACE not in piece.lstrip(SPACE):
            h = np.zeros(1, dtype=np.uint64)
            for c in piece:
                h = step_hash(h, np.array([ord(c)]))
                found.setdefault(int(h[0]), (-1, 0.0))
            found[int(h[0])] = (i, -math.log(rank + 2))
    for i in range(p.get_piece_size()):
        piece = p.id_to_piece(i)
        if p.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            spelt.append(bytes([int(piece[3:5], 16)]))
        else:
            spelt.append(b"" if p.is_control(i) or p.is_unknown(i) else piece.replace(SPACE, " ").encode())
    keys = sorted(found)
    hashes = np.array(keys, dtype=np.uint64)
    return Vocabulary(hashes, slot_tables(hashes), np.array([found[k][0] for k in keys]),
                      np.array([found[k][1] for k in keys]), tuple(byte_ids), tuple(spelt))


def uniform(x: np.ndarray) -> np.ndarray:
    """Hash to (0, 1)."""
    x = (x ^ (x >> np.uint64(33))) * MIX1
    x = (x ^ (x >> np.uint64(33))) * MIX2
    return ((x ^ (x >> np.uint64(33))) >> np.uint64(12)).astype(float) * 2.0 ** -52 + 2.0 ** -53


class Lattice:
    """The lattices of many words, all built at once. A node is a place in a word; its arcs are the pieces that fit
    there, with their chances given the node, so a random path is drawn arc by arc from the start. ``to`` is the
    next node, -1 at the end of the word; a character spelt in bytes is one arc with a negative piece."""

    def __init__(self, words: list[str], v: Vocabulary):
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        n = len(code)
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        left = np.repeat(np.cumsum(size), size) - np.arange(n)
        at, h, m = np.arange(n), np.zeros(n, dtype=np.uint64), 0
        arcs, degree = [], np.zeros(n, dtype=np.int64)
        while len(at):
            h = step_hash(h, code[at + m])
            m += 1
            spot = v.find(h)
            known = np.flatnonzero(spot >= 0)
            at, h, spot = at[known], h[known], spot[known]
            piece = v.piece[spot]
            whole = np.flatnonzero(piece >= 0)
            src = at[whole]
            arcs.append((src, m, degree[src], v.weight[spot[whole]], piece[whole]))
            degree[src] += 1
            if m == 1:
                spelt = np.flatnonzero(degree == 0)
                c = code[spelt]
                length = 1 + (c >= 0x80).astype(np.int64) + (c >= 0x800) + (c >= 0x10000)
                arcs.append((spelt, m, degree[spelt], BYTE_WEIGHT * length, -1 - c))
                degree[spelt] = 1
            more = np.flatnonzero(left[at] > m)
            at, h = at[more], h[more]
        # words are solved from their ends: nodes by what is left of the word, arcs with their nodes, short ones first
        order = np.argsort(left.astype(np.min_scalar_type(left.max(initial=0))), kind="stable")
        number = np.full(n + 1, -1)
        number[order] = np.arange(n)
        degree = degree[order]
        self.edge_at = np.append(0, np.cumsum(degree))
        begin = self.edge_at[number[:n]]
        self.piece, self.to, total = (np.empty(int(self.edge_at[-1]), dtype=t) for t in (np.int32, np.int32, float))
        for src, m, rank, w, piece in arcs:
            e = begin[src] + rank
            self.piece[e], total[e], self.to[e] = piece, w, np.where(left[src] > m, number[src + m], -1)
        beta = np.zeros(n + 1)  # the last one stands for the end of a word
        cuts = np.append(0, np.cumsum(np.bincount(left)[1:])).tolist()
        for i, j in zip(cuts[:-1], cuts[1:]):
            if i < j:
                a, b = self.edge_at[i], self.edge_at[j]
                total[a:b] += beta[self.to[a:b]]
                first = self.edge_at[i:j] - a
                top = np.maximum.reduceat(total[a:b], first)
                mass = np.add.reduceat(np.exp(total[a:b] - np.repeat(top, degree[i:j])), first)
                beta[i:j] = top + np.log(mass)
        total -= np.repeat(beta[:n], degree)
        self.logq = np.minimum(total, 0.0, out=total)
        self.roots = number[np.cumsum(size) - size]
        run = np.cumsum(np.exp(self.logq))
        before = np.append(0.0, run)[self.edge_at[:-1]]
        self.cum = np.clip(run - np.repeat(before, degree), 0.0, 1.0)
        self.cum += np.repeat(np.arange(n), degree)
        self.cum[self.edge_at[1:] - 1] = np.arange(n) + 1.0


def walk(roots: np.ndarray, seeds: np.ndarray, cum: np.ndarray, to: np.ndarray, edge_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One random path for each word, all words a step at a time: arcs in order, and where each word's begin."""
    unit, node, step = np.arange(len(roots)), roots, 0
    steps = []
    length = np.zeros(len(roots), dtype=np.int64)
    while len(unit):
        u = uniform(seeds[unit] + np.uint64(step * int(STEP) % 2 ** 64))
        e, want = edge_at[node], node + u
        late = np.flatnonzero(cum[e] <= want)
        while len(late):  # on to the next arc of the node; the last one always does
            e[late] += 1
            late = late[cum[e[late]] <= want[late]]
        steps.append((unit, e))
        length[unit] += 1
        node = to[e]
        go = np.flatnonzero(node >= 0)
        unit, node, step = unit[go], node[go], step + 1
    begin = np.append(0, np.cumsum(length))
    arcs = np.empty(begin[-1], dtype=np.int64)
    for step, (unit, e) in enumerate(steps):
        arcs[begin[unit] + step] = e
    return arcs, begin


def below(location: np.ndarray, bound: float, u: np.ndarray) -> np.ndarray:
    """Gumbel variables at ``location`` given that they are below ``bound``."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        return np.where(np.isneginf(location), -np.inf, location - np.log(np.exp(location - bound) - np.log(u)))


class Search:
    """The best-first search over the segmentations of one text; ``search`` leads those of a chunk together."""

    def __init__(self, paths: list, seed: int, lattice: Lattice):
        self.paths, self.logq, self.to, self.edge_at, self.cum = (paths, lattice.logq, lattice.to, lattice.edge_at,
                                                                  lattice.cum)
        self.seed, self.draws, self.queue, self.order, self.found = seed, 0, [], 0, []

    def noise(self) -> float:
        """The next number of this text's noise, as ``uniform`` gives it."""
        x = (self.seed + self.draws * int(UNIT_STEP)) % 2 ** 64
        self.draws += 1
        x = (x ^ (x >> 33)) * int(MIX1) % 2 ** 64
        x = (x ^ (x >> 33)) * int(MIX2) % 2 ** 64
        return float((x ^ (x >> 33)) >> 12) * 2.0 ** -52 + 2.0 ** -53

    def push(self, bound: float, arcs: np.ndarray, words: np.ndarray, t: int, out: tuple) -> None:
        if bound > -np.inf:
            self.order += 1
            heapq.heappush(self.queue, (-bound, self.order, arcs, words, t, out))

    def begin(self) -> tuple:
        """The path that is found first: (arcs, words, step from which on sets are passed by, bound)."""
        return *self.paths[0], 0, -math.log(-math.log(self.noise()))

    def fork(self, number: int) -> tuple:
        """A path out of the best set: it leaves ``arcs`` at step ``t`` by an arc that is not in ``out``; the remaining set is
        queued. As ``begin`` gives it."""
        bound, _, arcs, words, t, out = heapq.heappop(self.queue)
        bound = -bound
        node = int(np.searchsorted(self.edge_at, arcs[t], side="right")) - 1
        options = np.array([e for e in range(self.edge_at[node], self.edge_at[node + 1]) if e not in out])
        chance = np.exp(self.logq[options])
        e = int(options[min(int(np.searchsorted(np.cumsum(chance), self.noise() * chance.sum(), side="right")),
                            len(options) - 1)])
        new = [e]
        left = chance.sum() - math.exp(self.logq[e])
        if len(options) > 1 and left > 0:
            location = float(self.logq[arcs[:t]].sum()) + math.log(left)
            self.push(float(below(np.array([location]), bound, np.array([self.noise()]))[0]), arcs, words, t, (*out, e))
        while self.to[new[-1]] >= 0:  # to the end of the word
            new.append(int(np.searchsorted(self.cum, self.to[new[-1]] + self.noise(), side="right")))
        word = int(np.searchsorted(words, t, side="right")) - 1
        fresh, fresh_words = self.paths[number]
        path = np.concatenate([arcs[:t], np.array(new, dtype=np.int64), fresh[fresh_words[word + 1]:]])
        shift = t + len(new) - fresh_words[word + 1]
        return path, np.concatenate([words[:word + 1], fresh_words[word + 1:] + shift]), t + 1, bound


def branch(searches: list[Search], paths: list[tuple], lattice: Lattice, most: int) -> None:
    """Note the path that each search has found and queue the sets that it passed by. Only the ``most`` best of them can
    ever be popped or be the threshold."""
    arcs = np.concatenate([p[0] for p in paths])
    ends = np.cumsum([len(p[0]) for p in paths])
    lq = lattice.logq[arcs]
    mass = np.empty(len(arcs) + 1)  # log-probability of what comes before each step
    for a, b in zip([0, *ends.tolist()], ends.tolist()):
        np.cumsum(lq[a:b], out=mass[a + 1:b + 1])
    logp = mass[ends].tolist()
    mass[ends] = 0.0
    mass[0] = 0.0
    since = np.array([p[2] for p in paths])
    size = np.diff(ends, prepend=0) - since
    stop = np.cumsum(size)
    start = stop - size
    at = np.arange(stop[-1]) + np.repeat(ends - stop, size)
    draw = np.arange(stop[-1]) + np.repeat(np.array([s.draws for s in searches]) - start, size)
    u = uniform(np.repeat(np.array([s.seed for s in searches], dtype=np.uint64), size) + draw.astype(np.uint64) * UNIT_STEP)
    with np.errstate(divide="ignore"):
        rest = mass[at] + np.log1p(-np.minimum(np.exp(lq[at]), 1.0))
    g = below(rest, np.repeat([p[3] for p in paths], size), u)
    for s, (own, words, t, bound), x, a, b in zip(searches, paths, logp, start.tolist(), stop.tolist()):
        s.draws += b - a
        s.found.append((own, x, bound))
        mine = g[a:b]
        best = [mine.argmax()] if most == 1 and b > a else np.argpartition(-mine, most)[:most].tolist() if b - a > most else range(b - a)
        for i in best:
            s.push(float(mine[i]), own, words, t + i, (int(own[t + i]),))


def search(searches: list[Search], lattice: Lattice, samples: int) -> None:
    """Up to ``samples`` of each text in ``found``, (arcs, log-probability, perturbed value), best first."""
    if searches:
        branch(searches, [s.begin() for s in searches], lattice, samples)
    for number in range(1, samples):
        going = [s for s in searches if s.queue and len(s.found) == number]
        if going:
            branch(going, [s.fork(number) for s in going], lattice, samples - number)


def spelt_out(code: int) -> bytes:
    return (SPACE if chr(code) == LITERAL else chr(code)).encode()


def units_of(text: str) -> list[str]:
    if text and text[0] != " " and "  " not in text:  # each space begins a unit: no need of the pattern
        return list(filter(None, (SPACE + text.replace(SPACE, LITERAL).replace(" ", " " + SPACE).replace("\n", " \n ")).split(" ")))
    return UNIT.findall(SPACE + text.replace(SPACE, LITERAL).replace(" ", SPACE)) if text else []


def in_bytes(ids: np.ndarray, v: Vocabulary, byte_id: np.ndarray) -> np.ndarray:
    """Ids with byte pieces for the characters that no piece covers."""
    code = -1 - ids
    if code.max() < 0x80:  # one byte each
        return np.where(code >= 0, byte_id[np.maximum(code, 0)], ids)
    return np.array([x for p in ids.tolist() for x in ([v.byte_ids[b] for b in spelt_out(-1 - p)] if p < 0 else (p,))],
                    dtype=np.int64)


def decoded(ids, spelt: tuple) -> str:
    """The text of a segmentation: its bytes without the space that every text begins with."""
    return b"".join(map(spelt.__getitem__, ids.tolist())).decode()[1:] if len(ids) else ""


@dataclass(frozen=True)
class Spelling:
    """The bytes of all ids one after the other, and where each id's begin."""
    data: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, spelt: tuple) -> "Spelling":
        return cls(np.frombuffer(b"".join(spelt), dtype=np.uint8), np.append(0, np.cumsum([len(x) for x in spelt])))

    def decoded(self, ids: list) -> list[bytes]:
        """``decoded`` of many segmentations, in UTF-8."""
        ends = np.append(0, np.cumsum([len(x) for x in ids])).astype(np.int64)
        flat = np.concatenate([np.zeros(0, np.int64), *(np.asarray(x, dtype=np.int64) for x in ids)])
        size = self.at[flat + 1] - self.at[flat]
        to = np.append(0, np.cumsum(size))
        parts = []
        for a in range(0, len(flat), SPELT_AT_ONCE):
            b = min(a + SPELT_AT_ONCE, len(flat))
            parts.append(self.data[np.arange(to[a], to[b]) + np.repeat(self.at[flat[a:b]] - to[a:b], size[a:b])].tobytes())
        text, cuts = b"".join(parts), to[ends].tolist()
        return [text[a + 1:b] for a, b in zip(cuts[:-1], cuts[1:])]


def added(held: np.ndarray, used: int, new: np.ndarray) -> np.ndarray:
    """``new`` after the first ``used`` values; what holds them doubles when it is full, so that little is copied."""
    if used + len(new) > len(held):
        more = np.empty(max(used + len(new), 2 * len(held)), dtype=new.dtype)
        more[:used] = held[:used]
        held = more
    held[used:used + len(new)] = new
    return held


@dataclass
class Known:
    """The words that a task has met, numbered in this order, with their lattices."""
    types: defaultdict = field(default_factory=lambda: defaultdict(count().__next__))
    lattice: Lattice | None = None
    held: dict = field(default_factory=dict)

    def learn(self, v: Vocabulary) -> Lattice:
        """The lattices of all words, those of new ones solved now and put after the others, as many at a time as stay
        near the processor."""
        have = 0 if self.lattice is None else len(self.lattice.roots)
        words = list(islice(self.types, have, None))
        for a in range(0, max(len(words), self.lattice is None), SOLVED_AT_ONCE):
            self.add(Lattice(words[a:a + SOLVED_AT_ONCE], v))
        return self.lattice

    def add(self, new: Lattice) -> None:
        old = self.lattice
        arcs, nodes, words = (0, 0, 0) if old is None else (len(old.piece), len(old.edge_at) - 1, len(old.roots))
        new.to[new.to >= 0] += nodes
        new.edge_at += arcs
        new.cum += nodes
        new.roots += nodes
        self.lattice = object.__new__(Lattice)
        for name, used in (("piece", arcs), ("logq", arcs), ("to", arcs), ("cum", arcs), ("edge_at", nodes), ("roots", words)):
            x = getattr(new, name)
            self.held[name] = added(self.held.get(name, x[:0]), used, x)
            setattr(self.lattice, name, self.held[name][:used + len(x)])


def encode_texts(keys: list, texts: list, v: Vocabulary, spec: PieceSampler, known: Known | None = None) -> list[tuple]:
    """(row, sample, ids, log_prob, perturbed, kappa) of the samples of a chunk of texts."""
    known = Known() if known is None else known
    types = known.types
    words, sizes = [], []
    for t in texts:
        units = units_of(t)
        words.extend(map(types.__getitem__, units))
        sizes.append(len(units))
    lattice = known.learn(v)
    sizes = np.array(sizes, dtype=np.int64)
    roots = lattice.roots[np.array(words, dtype=np.int64)]
    seeds = np.array([xxhash.xxh3_64_intdigest(f"{spec.seed}:{key}") for key in keys], dtype=np.uint64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    within = (np.arange(len(roots)) - np.repeat(at[:-1], sizes)).astype(np.uint64)
    unit_seed = np.repeat(seeds, sizes) + (within + np.uint64(1)) * UNIT_STEP
    walks = [walk(roots, uniform_seed(unit_seed, s), lattice.cum, lattice.to, lattice.edge_at) for s in range(spec.samples)]
    searches = {i: Search([(arcs[w[at[i]]:w[at[i + 1]]], w[at[i]:at[i + 1] + 1] - w[at[i]]) for arcs, w in walks], int(seeds[i]), lattice)
                for i in np.flatnonzero(sizes).tolist()}
    search(list(searches.values()), lattice, spec.samples)
    out, byte_id = [], np.array(v.byte_ids)
    for i in range(len(texts)):
        if i not in searches:
            out.append((i, 0, [], 0.0, 0.0, -math.inf))
            continue
        done = searches[i]
        kappa = -done.queue[0][0] if done.queue else -np.inf
        for s, (arcs, logp, g) in enumerate(done.found):
            ids = lattice.piece[arcs]
            out.append((i, s, in_bytes(ids, v, byte_id) if (ids < 0).any() else ids, logp, g, kappa))
    return out


def uniform_seed(x: np.ndarray, sample: int) -> np.ndarray:
    """Seeds of the words' walks, scrambled so that steps of neighbouring words do not coincide."""
    x = x + np.uint64((sample + 1) * int(SAMPLE_STEP) % 2 ** 64)
    x = (x ^ (x >> np.uint64(31))) * MIX2
    return x ^ (x >> np.uint64(29))


def sampler(vocabulary: Vocabulary, spec: PieceSampler, others: list[str], check: bool):
    spelling = Spelling.of(vocabulary.spelt)

    def frame(rows: list, known: Known) -> pd.DataFrame:
        got = encode_texts([r[0] for r in rows], [r[1] or "" for r in rows], vocabulary, spec, known)
        kappa = np.array([x[5] for x in got], dtype=float)
        logp = np.array([x[3] for x in got], dtype=float)
        with np.errstate(over="ignore"):
            inclusion = -np.expm1(-np.exp(np.minimum(logp - kappa, 50.0)))
        data = {"sample": [x[1] for x in got], "n_pieces": [len(x[2]) for x in got], "log_prob": logp,
                "perturbed": [x[4] for x in got], "inclusion": np.where(np.isneginf(kappa), 1.0, inclusion),
                "ids": [np.asarray(x[2], dtype=np.int32) for x in got],
                "doc_id": pd.Series([rows[x[0]][0] for x in got], dtype=object)}
        if check:
            back = spelling.decoded([x[2] for x in got])
            data["round_trip"] = [b == (rows[x[0]][1] or "").encode() for x, b in zip(got, back)]
        for j, c in enumerate(others):
            data[c] = pd.Series([rows[x[0]][2 + j] for x in got], dtype=object)
        return pd.DataFrame(data)

    def sample(batches):
        rows, chars, known = [], 0, Known()
        for pdf in batches:
            for r in pdf.itertuples(index=False, name=None):
                rows.append(tuple(None if x is None or x != x else x for x in r))
                chars += max(len(r[1] or ""), 40)
                if chars >= spec.chunk_chars:
                    yield frame(rows, known)
                    rows, chars = [], 0
                    if known.lattice is not None and len(known.lattice.edge_at) > spec.word_chars:
                        known = Known(held=known.held)  # what is in the old arrays is not read again
        if rows:
            yield frame(rows, known)
    return sample


def encode(docs: DataFrame, spec: PieceSampler = PieceSampler(), id_col: str = "doc_id", text_col: str = "text",
           keep: tuple = (), check: bool = False) -> DataFrame:
    """Rows of id, sample (from 0), n_pieces, log_prob, perturbed, inclusion, ids, and the columns in ``keep``; with
    ``check`` also round_trip, whether decoding the ids gives the text back."""
    vocabulary = load(spec.model)
    types = dict(docs.dtypes)
    # the id goes through Python as a string: a batch with a null would make numbers of it that are not exact
    rows = small_batches(docs).select(F.col(id_col).cast("string").alias("_key"), F.col(text_col).alias("_text"), *[F.col(c) for c in keep])
    schema = "doc_id string, sample int, n_pieces int, log_prob double, perturbed double, inclusion double, ids array<int>"
    schema += ", round_trip boolean" * check + "".join(f", `{c}` {types[c]}" for c in keep)
    names = ["doc_id", "sample", "n_pieces", "log_prob", "perturbed", "inclusion", "ids", *["round_trip"] * check, *keep]
    out = rows.mapInPandas(giving_back(sampler(vocabulary, spec, list(keep), check)), schema)
    return out.withColumn("doc_id", F.col("doc_id").cast(types[id_col])).select(*names)


def decode(ids: Column, spec: PieceSampler = PieceSampler()) -> Column:
    """The text that a column of id arrays stands for; null for null."""
    spelt = load(spec.model).spelt

    def text(arrays: pd.Series) -> pd.Series:
        return pd.Series([None if a is None else decoded(a, spelt) for a in arrays], dtype=object)

    return F.pandas_udf(text, "string")(ids)
