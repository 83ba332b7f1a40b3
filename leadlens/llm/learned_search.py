"""Approximate nearest neighbours by learned partitions.

Fitting, on a bounded sample (``fit_rows`` rows of smallest hash): every sampled vector is joined to its ``degree``
nearest, the neighbour graph is cut into equal parts by moving vertices to the part that holds most of their neighbours
while there is room, and a small network with one hidden layer learns, from the vector alone, in which parts a vector and
its neighbours lie. Every row is then indexed in its most probable part, and a query goes to its ``probes`` most probable
parts, where all rows are ranked exactly. ``probes`` is the smallest number that finds the share ``recall`` of the true
neighbours of held-out sample rows, so that it follows the data: vectors with little structure need many parts.

Rows are packed into blocks of one part and the queries of a part into blocks too; the blocks of a part meet on a grid
whose cells are spread by hash, so that a part with a third of all rows is many cells and no task holds more than a few
blocks at a time. A block returns ``k`` rows a query, which are ranked in a last step. The driver sees the sample
(``fit_rows`` vectors), the network and one block count a part.

Edge cases: vectors that are null, zero or hold null or non-finite components and rows without an id take no part;
vectors meet only vectors of their length, and lengths that the sample lacks have a single part; equal scores rank by the
smaller id; repeated rows are candidates one by one but never for a query of the same id, and a repeated query row counts
once; an empty table gives an empty result; only id and vector are read, other columns cannot clash.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_value, stored
from .topk_search import usable

by_value(__name__)

PACKED = "dim int, part int, n int, ids binary, vectors binary"


@dataclass(frozen=True)
class Learned:
    k: int = 20
    fit_rows: int = 8192     # most rows that the fit sees
    parts: int = 16          # most parts
    part_rows: int = 64      # least sampled rows a part
    degree: int = 20
    hidden: int = 128
    epochs: int = 15
    recall: float = 0.93     # of held-out sample rows' neighbours
    held_out: int = 512      # sample rows that the network does not see
    block_rows: int = 2048
    query_rows: int = 512
    seed: int = 13


def nearest(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` rows with the largest inner product, but for the query's own place."""
    out = np.empty((len(queries), k), dtype=np.int64)
    for a in range(0, len(queries), 256):
        s = queries[a:a + 256] @ rows.T
        s[np.arange(len(s)), own[a:a + 256]] = -np.inf
        out[a:a + 256] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(graph: np.ndarray, parts: int, rng: np.random.Generator, rounds: int = 30, spare: float = 0.05) -> np.ndarray:
    """Parts of equal size, but for ``spare``, that cut few edges: from a random start each vertex moves to the part with
    most of its neighbours while that has room, those that gain most first."""
    n = len(graph)
    room = int(np.ceil(n / parts * (1 + spare)))
    part = rng.permutation(n) % parts
    here = np.repeat(np.arange(n), graph.shape[1])
    a, b = np.concatenate([here, graph.ravel()]), np.concatenate([graph.ravel(), here])
    for _ in range(rounds):
        friends = np.bincount(a * parts + part[b], minlength=n * parts).reshape(n, parts)
        best = friends.argmax(axis=1)
        gain = friends[np.arange(n), best] - friends[np.arange(n), part]
        order = np.argsort(-gain, kind="stable")
        order = order[(gain[order] > 0) & (rng.random(n) < 0.7)]  # not all at once, or neighbours change places for ever
        size, moved = np.bincount(part, minlength=parts), 0
        for i in order.tolist():
            if size[best[i]] < room:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i], moved = best[i], moved + 1
        if moved <= n // 500:
            break
    return part


@dataclass
class Router:
    """A network from a vector to the probabilities of the parts; no weights: a single part."""
    weights: list[np.ndarray]
    parts: int = 1
    probes: int = 1
    recall: float = 1.0  # of the held-out rows, at ``probes``

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        if self.parts == 1:
            return np.ones((len(x), 1))
        w1, b1, w2, b2 = self.weights
        z = np.maximum(x @ w1 + b1, 0) @ w2 + b2
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def ranked(self, x: np.ndarray) -> np.ndarray:
        """Parts by falling probability, per row."""
        return np.argsort(-self.probabilities(x), axis=1, kind="stable")


def unit(x: np.ndarray) -> np.ndarray:
    """Directions; the network sees no lengths, which may differ by orders of magnitude."""
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / top
    return x / np.sqrt((x ** 2).sum(axis=1, keepdims=True))


def learned(x: np.ndarray, target: np.ndarray, spec: Learned, rng: np.random.Generator) -> list[np.ndarray]:
    """Weights by Adam on the cross-entropy against the target shares."""
    d, m = x.shape[1], target.shape[1]
    w = [rng.normal(0, np.sqrt(2 / d), (d, spec.hidden)), np.zeros(spec.hidden),
         rng.normal(0, np.sqrt(1 / spec.hidden), (spec.hidden, m)), np.zeros(m)]
    mean, square, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for _ in range(spec.epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            i = order[at:at + 256]
            h = np.maximum(x[i] @ w[0] + w[1], 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            dz = (p / p.sum(axis=1, keepdims=True) - target[i]) / len(i)
            dh = dz @ w[2].T * (h > 0)
            t += 1
            for q, g in enumerate((x[i].T @ dh, dh.sum(axis=0), h.T @ dz, dz.sum(axis=0))):
                mean[q] = 0.9 * mean[q] + 0.1 * g
                square[q] = 0.999 * square[q] + 0.001 * g * g
                w[q] = w[q] - 3e-3 * (mean[q] / (1 - 0.9 ** t)) / (np.sqrt(square[q] / (1 - 0.999 ** t)) + 1e-8)
    return w


def fit_router(sample: np.ndarray, spec: Learned) -> Router:
    """Graph, parts and network of sampled vectors of one length; repeated vectors count once."""
    sample = np.unique(sample, axis=0)
    rng = np.random.default_rng(spec.seed)
    sample = sample[rng.permutation(len(sample))]
    parts = min(spec.parts, len(sample) // spec.part_rows)
    if parts < 2:
        return Router([])
    x = unit(sample)
    scale = np.abs(sample).max()
    rows = sample / scale  # inner products keep their order
    graph = nearest(rows, np.arange(len(rows)), rows, min(spec.degree, len(rows) - 1))
    part = balanced_parts(graph, parts, rng)
    share = np.zeros((len(rows), parts))
    np.add.at(share, (np.repeat(np.arange(len(rows)), graph.shape[1]), part[graph].ravel()), 0.5 / graph.shape[1])
    share[np.arange(len(rows)), part] += 0.5
    kept = min(spec.held_out, len(rows) // 4)
    router = Router(learned(x[kept:], share[kept:], spec, rng), parts)
    ranks = np.argsort(router.ranked(x[:kept]), axis=1)
    home = router.ranked(x)[:, 0]
    true = nearest(rows[:kept], np.arange(kept), rows, min(spec.k, len(rows) - 1))
    place = np.take_along_axis(ranks, home[true], axis=1)
    found = [float((place < p).mean()) for p in range(1, parts + 1)]
    router.probes = next(p for p in range(1, parts + 1) if found[p - 1] >= spec.recall or p == parts)
    router.recall = found[router.probes - 1]
    return router


def matrix(vectors: list, dim: int) -> np.ndarray:
    return np.array(vectors, dtype=float).reshape(len(vectors), dim)


def packer(routers: dict[int, Router], spec: Learned, queries: bool):
    """Rows of (id, v, dim) to blocks of one length and part: a row's most probable part, or a query's ``probes`` parts."""
    size = spec.query_rows if queries else spec.block_rows

    def block(dim: int, part: int, ids: list, vectors: list) -> pd.DataFrame:
        return pd.DataFrame({"dim": [dim], "part": [part], "n": [len(ids)], "ids": [np.array(ids, dtype=np.int64).tobytes()],
                             "vectors": [np.stack(vectors).tobytes()]})

    def run(batches: Iterator[pd.DataFrame]):
        held: dict = {}
        for pdf in batches:
            for dim, rows in pdf.groupby("dim"):
                router = routers.get(dim, Router([]))
                x = matrix(rows["v"].tolist(), dim)
                parts = router.ranked(unit(x))[:, :router.probes if queries else 1]
                for i, v, ps in zip(rows["id"].tolist(), x, parts.tolist()):
                    for p in ps:
                        ids, vectors = held.setdefault((dim, p), ([], []))
                        ids.append(i)
                        vectors.append(v)
                        if len(ids) >= size:
                            yield block(dim, p, *held.pop((dim, p)))
        for (dim, p), (ids, vectors) in held.items():
            yield block(dim, p, ids, vectors)
    return run


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products row by row, added from the first component to the last, so that equal vectors get equal scores."""
    out = np.zeros(len(q))
    for d in range(q.shape[1]):
        out += q[:, d] * v[:, d]
    return out


def best(qids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries and of rows, and scores, of each query's ``k`` best rows of a block."""
    rough = q @ v.T
    rough[qids[:, None] == ids[None, :]] = -np.inf
    if len(ids) > k:
        cut = -np.partition(-rough, k - 1, axis=1)[:, k - 1]
    else:
        cut = np.full(len(q), -np.inf)
    norm = np.sqrt((q ** 2).sum(axis=1)) * np.sqrt((v ** 2).sum(axis=1).max(initial=0))
    near = (rough >= (cut - 1e-12 * norm * len(q[0]))[:, None]) & (rough > -np.inf)  # rounding can only add rows
    qi, vi = np.nonzero(near)
    score = np.concatenate([products(q[qi[a:a + 65536]], v[vi[a:a + 65536]]) for a in range(0, len(qi), 65536)] or [np.zeros(0)])
    order = np.lexsort((ids[vi], -score, qi))
    qi, vi, score = qi[order], vi[order], score[order]
    first = np.searchsorted(qi, np.arange(len(q)))
    keep = np.arange(len(qi)) - first[qi] < k
    return qi[keep], vi[keep], score[keep]


def searcher(spec: Learned):
    def run(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            for r in pdf.itertuples():
                ids, qids = np.frombuffer(r.ids, np.int64), np.frombuffer(r.q_ids, np.int64)
                v, q = np.frombuffer(r.vectors).reshape(len(ids), -1), np.frombuffer(r.q_vectors).reshape(len(qids), -1)
                qi, vi, score = best(qids, q, ids, v, spec.k)
                key = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) >> 1 for x in q], dtype=np.int64)  # tells queries of one id apart
                yield pd.DataFrame({"query_id": qids[qi], "query_key": key[qi], "vec_id": ids[vi], "score": score})
    return run


def search(rows: DataFrame, is_query: Column, spec: Learned = Learned(), id_col: str = "vec_id",
           vector_col: str = "embedding", routers: dict[int, Router] | None = None) -> DataFrame:
    """Per query: query_id, rank, vec_id and score of the ``k`` nearest rows found. ``routers`` given: not fitted anew;
    an empty dict: filled with what is fitted."""
    good = rows.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull() & F.exists(vector_col, lambda x: x != 0))
    good = good.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
                       F.coalesce(is_query, F.lit(False)).alias("asks"), F.size(vector_col).alias("dim"))
    routers = {} if routers is None else routers
    if not routers:
        taken: dict = {}
        for r in good.select("dim", "v").orderBy(F.xxhash64("id", "v")).limit(spec.fit_rows).collect():
            taken.setdefault(r["dim"], []).append(r["v"])
        routers.update({d: fit_router(matrix(vs, d), spec) for d, vs in taken.items()})
    blocks = stored(good.select("id", "v", "dim").mapInPandas(packer(routers, spec, False), PACKED), "ann-rows")
    asked = good.filter("asks").select("id", "v", "dim").distinct()
    queries = stored(asked.mapInPandas(packer(routers, spec, True), PACKED), "ann-queries")
    # a grid a part: cells of about two blocks of rows by four of queries
    count = lambda t, name, by: (t.groupBy("dim", "part").agg(F.ceil(F.count(F.lit(1)) / by).alias(name)))
    grid = count(blocks, "g_all", 2).join(count(queries, "h_all", 4), ["dim", "part"])
    cell, names = F.xxhash64("ids"), ("ids", "vectors")
    b = blocks.join(F.broadcast(grid), ["dim", "part"]).select(  # one row a part
        "dim", "part", *names, F.pmod(cell, F.col("g_all")).alias("g"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("h_all") - 1)).alias("h"))
    q = queries.join(F.broadcast(grid), ["dim", "part"]).select(
        "dim", "part", *[F.col(c).alias(f"q_{c}") for c in names], F.pmod(cell, F.col("h_all")).alias("h"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("g_all") - 1)).alias("g"))
    pairs = b.join(q, ["dim", "part", "g", "h"]).select(*names, *[f"q_{c}" for c in names])
    near = pairs.mapInPandas(searcher(spec), "query_id long, query_key long, vec_id long, score double")
    w = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    return (near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= spec.k)
            .select("query_id", "rank", "vec_id", "score"))
