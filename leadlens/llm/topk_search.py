"""Exact top-k search by inner product with a pivot table.

Components become integers ``floor(scale * x)``. Pivots are rows far apart from each other (farthest first over
a bounded sample), as many as ``pivot_share`` of the rows, at most ``pivots``, and every row's distances to all of them
are known. For a query ``q`` the largest of ``|d(q, p) - d(v, p)|`` over pivots is a lower bound of
``d(q, v)``, and with both lengths known an upper bound of the inner product. The pivots that can make it large are
those nearest to and farthest from the query (``by_query`` of them) and those nearest to the row (``by_row``), so these
are looked up; the tables hold distances in one byte each, in steps that are the same for all rows of a length, and the bound
allows for the rounding. Candidates of a block are evaluated exactly in the order of that bound until the k-th best score
known is above every bound that is left, so the result is exact. Where the bounds of some rows of a block (``looked_at``)
show that they would leave ``dense`` of it or more, all of the block is evaluated, for many queries at once.

Rows are packed into blocks, the stated query set too. Every task takes some blocks of rows past the query blocks, so that
nothing is exchanged but the rows and the queries themselves, makes the tables of a block when it comes to it, and keeps the
``k`` best rows of each query over all its blocks; only these go on to the final ranking. A first pass over one block of rows
gives each query a score that k rows reach; it goes with the query to every task, which so needs not find its own best rows
first. Nothing but the sample (``sample`` rows) reaches the driver, and the pivots go back as a broadcast of at most ``pivots``
rows.

``evaluated`` of a result row is the number of candidates whose score was computed for its query, in both passes.

Edge cases: null vectors, vectors that hold a null or non-finite component and rows without an id take
no part; vectors meet only vectors of their length; equal scores rank by smaller id; rows that repeat an
id are candidates one by one, but never for a query of the same id, and a repeated query row counts once;
an empty table gives an empty result; only id and vector are read, other columns cannot clash.
"""
from __future__ import annotations

from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_value, stored

by_value(__name__)


@dataclass(frozen=True)
class TopK:
    k: int = 5
    scale: int = 256
    pivots: int = 1024
    pivot_share: float = 0.4
    sample: int = 8192
    block_rows: int = 4096
    query_rows: int = 1024
    asked_rows: int = 1 << 16  # queries that a task takes past its rows
    chunk: int = 16            # candidates evaluated at first; twice as many each time
    by_query: int = 32
    by_row: int = 4
    looked_at: int = 256
    dense: float = 0.75


def integers(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.forall(vector, finite)


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    if not len(pivots):
        return np.zeros((len(rows), 0))
    most = max(np.abs(rows).max(initial=0), np.abs(pivots).max(initial=0))
    if 4 * rows.shape[1] * most ** 2 < 2 ** 53:  # all sums are exact
        return np.sqrt((rows ** 2).sum(axis=1)[:, None] + (pivots ** 2).sum(axis=1) - 2 * (rows @ pivots.T))
    return np.stack([np.sqrt(((rows - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def far_apart(rows: np.ndarray, n: int) -> np.ndarray:
    """``n`` of ``rows``, each the farthest from those before it; fewer if the others repeat these."""
    if not len(rows) or n < 1:
        return rows[:0]
    chosen, gap = [0], ((rows - rows[0]) ** 2).sum(axis=1)
    while len(chosen) < n and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    return rows[chosen]


def nearest(d: np.ndarray, m: int) -> np.ndarray:
    """Places of the ``m`` pivots nearest to each row."""
    m = min(m, d.shape[1])
    return np.argpartition(d, m - 1, axis=1)[:, :m] if m else np.zeros((len(d), 0), dtype=np.int64)


@dataclass(frozen=True)
class Pivots:
    """Pivots of one length, and the step in which distances to them are kept, from 0: pivots are rows themselves."""
    rows: np.ndarray
    step: float = 0.0

    @classmethod
    def of(cls, sample: np.ndarray, n: int) -> "Pivots":
        rows = far_apart(sample, n)
        return cls(rows, float(distances(sample[:2048], rows).max(initial=0.0)) / 255)

    def in_bytes(self, d: np.ndarray) -> np.ndarray:
        """Distances beyond those of the sample count as its largest, which brings two of them nearer at most."""
        return np.minimum(np.rint(d / (self.step or 1.0)), 255).astype(np.uint8)

    def least(self) -> np.ndarray:
        """Square of the least distance of two vectors by the steps between their distances to a pivot."""
        return (np.maximum(np.arange(256) - 1 - 1e-3, 0) * self.step) ** 2


NO_PIVOTS = Pivots(np.zeros((0, 0)))
NONE = np.iinfo(np.int64).min


def packed(vectors: np.ndarray) -> tuple[bytes, int]:
    """Integers in as few bytes as they need, and how many these are."""
    most = max(int(vectors.max(initial=0)), -int(vectors.min(initial=0)) - 1)
    size = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
    return vectors.astype(f"i{size}").tobytes(), size


def unpacked(data: bytes, size: int, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(data, f"i{size}").reshape(n, dim).astype(np.int64)


def held_rows(batches, block_rows: int):
    """Rows of (id, v, dim) by dimension, at most ``block_rows`` at a time: dim, ids, vectors."""
    held: dict = {}
    full = lambda dim, ids, vectors: (dim, np.array(ids, dtype=np.int64), np.array(vectors, dtype=np.int64).reshape(len(ids), dim))
    for pdf in batches:
        for i, v, dim in zip(pdf["id"], pdf["v"], pdf["dim"]):
            ids, vectors = held.setdefault(dim, ([], []))
            ids.append(i)
            vectors.append(v)
            if len(ids) >= block_rows:
                yield full(dim, *held.pop(dim))
    for dim, (ids, vectors) in held.items():
        yield full(dim, ids, vectors)


ROWS = "dim int, block long, ids binary, vectors binary, size int"


def packer(block_rows: int):
    """Rows of (id, v, dim) to blocks of one dimension: ids and vectors as packed arrays."""
    def pack(batches):
        for dim, ids, m in held_rows(batches, block_rows):
            data, size = packed(m)
            yield pd.DataFrame({"dim": [dim], "block": [xxhash.xxh3_64_intdigest(ids.tobytes() + data) >> 1], "ids": [ids.tobytes()],
                                "vectors": [data], "size": [size]})
    return pack


ASKED = "q_dim int, q_block long, q_ids binary, q_keys binary, q_vectors binary, q_size int, q_table binary, q_looked binary"


def query_packer(spec: TopK, shared):
    """The same of queries, with their distances to all pivots in bytes and the pivots to look up."""
    def pack(batches):
        for dim, ids, m in held_rows(batches, spec.query_rows):
            data, size = packed(m)
            p = shared.value.get(dim, NO_PIVOTS)
            d = distances(m.astype(float), p.rows)
            looked = np.concatenate([nearest(d, spec.by_query // 2), nearest(-d, spec.by_query // 2)], axis=1)
            keys = np.array([query_key(v) for v in m], dtype=np.int64)
            yield pd.DataFrame({"q_dim": [dim], "q_block": [xxhash.xxh3_64_intdigest(ids.tobytes() + data) >> 1], "q_ids": [ids.tobytes()],
                                "q_keys": [keys.tobytes()], "q_vectors": [data], "q_size": [size],
                                "q_table": [p.in_bytes(d).tobytes()], "q_looked": [looked.astype(np.int32).tobytes()]})
    return pack


class Vectors:
    """Vectors of a block in the type in which their products are exact."""

    def __init__(self, data: bytes, size: int, dim: int, n: int):
        self.v = unpacked(data, size, dim, n)
        self.as_float, self.most = self.v.astype(float), float(np.abs(self.v).max(initial=0))
        self.sq, self.typed = (self.as_float ** 2).sum(axis=1), {}

    def of_type(self, kind) -> np.ndarray:
        if kind not in self.typed:
            self.typed[kind] = self.v.astype(kind)
        return self.typed[kind]

    def kind(self, other: "Vectors"):
        """Floating point only where all sums are exact."""
        most = self.most * other.most * max(1, self.v.shape[1])
        return np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64


def steps_apart(table: np.ndarray, near: np.ndarray, near_table: np.ndarray, q_table: np.ndarray, looked: np.ndarray) -> np.ndarray:
    """(queries, rows): the largest difference of distances to a pivot that is looked up, in steps."""
    out = np.zeros((len(q_table), table.shape[1]), np.uint8)
    for t, q in ((table[looked], np.take_along_axis(q_table, looked, axis=1)[:, :, None]), (near_table[None], q_table[:, near])):
        if q.shape[1]:
            np.maximum(out, (np.maximum(t, q) - np.minimum(t, q)).max(axis=1), out=out)
    return out


class Block(Vectors):
    """One block of rows as it is searched: vectors, squared lengths, and the pivot table by pivot."""

    def __init__(self, r, pivots: Pivots, spec: TopK):
        self.ids = np.frombuffer(r.ids, dtype=np.int64)
        n = len(self.ids)
        super().__init__(r.vectors, r.size, r.dim, n)
        self.table = np.empty((len(pivots.rows), n), np.uint8)
        near = []
        for a in range(0, n, 1024):
            d = distances(self.as_float[a:a + 1024], pivots.rows)
            near.append(nearest(d, spec.by_row))
            self.table[:, a:a + 1024] = pivots.in_bytes(d).T
        self.near = np.ascontiguousarray(np.concatenate(near).T)
        self.near_table = np.take_along_axis(self.table, self.near, axis=0)
        self.least = pivots.least()
        self.some = np.arange(0, n, max(1, n // spec.looked_at))
        self.some_tables = [np.ascontiguousarray(x[:, self.some]) for x in (self.table, self.near, self.near_table)]
        self.by_id = np.sort(self.ids)

    def bound(self, sq_q, sq: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner products; rounding can only make them larger."""
        return (sq_q + sq - self.least[apart]) / 2 + 1e-9 * (sq_q + sq) + 1

    def bounds(self, q: "Queries", i: int) -> np.ndarray:
        """Upper bounds of the inner products of one query with the rows."""
        return self.bound(q.sq[i], self.sq, steps_apart(self.table, self.near, self.near_table, q.table[i:i + 1], q.looked[i:i + 1])[0])

    def share(self, q: "Queries", chunk: int = 64) -> np.ndarray:
        """For each query the share of some rows that its bounds and the score it has reached leave."""
        out = np.ones(len(q.ids))
        for a in range(0, len(out), chunk):
            at = slice(a, a + chunk)
            apart = steps_apart(*self.some_tables, q.table[at], q.looked[at])
            out[at] = (self.bound(q.sq[at, None], self.sq[self.some], apart) >= q.reached[at, None]).mean(axis=1)
        return out

    def others(self, qid) -> np.ndarray:
        """Rows of another id."""
        return len(self.ids) - (np.searchsorted(self.by_id, qid, "right") - np.searchsorted(self.by_id, qid, "left"))


class Queries(Vectors):
    """One block of queries, the score that ``k`` rows are known to reach (``NONE``: no score) and the best rows found."""

    def __init__(self, r, k: int):
        self.k, self.ids, self.keys = k, np.frombuffer(r.q_ids, dtype=np.int64), np.frombuffer(r.q_keys, dtype=np.int64)
        n = len(self.ids)
        super().__init__(r.q_vectors, r.q_size, r.q_dim, n)
        self.table = np.frombuffer(r.q_table, np.uint8).reshape(n, -1)
        self.looked = np.frombuffer(r.q_looked, np.int32).reshape(n, -1)
        known = dict(zip(r.r_keys, r.r_scores)) if r.r_keys is not None else {}
        self.reached = np.array([known.get(f"{i}:{key}", NONE) for i, key in zip(self.ids.tolist(), self.keys.tolist())], dtype=np.int64)
        self.evaluated = np.zeros(n, np.int64)
        self.at, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, at: list, score: list, id_: list) -> None:
        """Rows found: place of the query, score, id."""
        at, score, id_ = (np.concatenate([x, *more]) for x, more in ((self.at, at), (self.score, score), (self.id, id_)))
        order = np.lexsort((id_, -score, at))
        at, score, id_ = at[order], score[order], id_[order]
        place = np.arange(len(at)) - np.searchsorted(at, at, "left")
        keep = place < self.k
        self.at, self.score, self.id, last = at[keep], score[keep], id_[keep], place == self.k - 1
        self.reached[at[last]] = np.maximum(self.reached[at[last]], score[last])


def best_of_block(q: Queries, i: int, block: Block, kind, spec: TopK) -> tuple[np.ndarray, np.ndarray, int]:
    """Scores and ids of rows of one block that hold its k best for one query among those that score what it has reached or
    more, evaluated in the order of their bounds, and how many were evaluated."""
    own, bound, least = block.ids != q.ids[i], block.bounds(q, i), int(q.reached[i])
    if least != NONE:
        own &= bound >= least
    order = np.flatnonzero(own)
    order = order[np.argsort(-bound[order])]
    ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    v, asked = block.of_type(kind), q.of_type(kind)[i]
    at, size = 0, spec.chunk if least == NONE else max(spec.chunk, len(order) // 4)
    while at < len(order):
        part = order[at:at + size]
        if least != NONE:  # bounds fall along the order
            part = part[:int(np.searchsorted(-bound[part], -least, side="right"))]
            if not len(part):
                break
        score = (v[part] @ asked).astype(np.int64)
        at, size = at + len(part), 2 * size
        keep = score >= least
        scores, ids = np.concatenate([scores, score[keep]]), np.concatenate([ids, block.ids[part[keep]]])
        if len(scores) >= spec.k:
            best = np.lexsort((ids, -scores))[:spec.k]
            scores, ids = scores[best], ids[best]
            least = max(least, int(scores[-1]))
    return scores, ids, at


def search_block(q: Queries, block: Block, spec: TopK, chunk: int = 256) -> None:
    """One block of rows for all queries of a block."""
    kind = block.kind(q)
    dense = (q.reached != NONE) & (block.share(q) >= spec.dense)
    found: tuple[list, list, list] = ([], [], [])
    all_ = np.flatnonzero(dense)
    for a in range(0, len(all_), chunk):
        at = all_[a:a + chunk]
        score = q.of_type(kind)[at] @ block.of_type(kind).T
        i, row = np.nonzero(score >= q.reached[at, None].astype(kind))
        other = block.ids[row] != q.ids[at[i]]
        i, row = i[other], row[other]
        for x, more in zip(found, (at[i], score[i, row].astype(np.int64), block.ids[row])):
            x.append(more)
        q.evaluated[at] += block.others(q.ids[at])
    for i in np.flatnonzero(~dense).tolist():
        scores, ids, done = best_of_block(q, i, block, kind, spec)
        for x, more in zip(found, (np.full(len(ids), i), scores, ids)):
            x.append(more)
        q.evaluated[i] += done
    q.add(*found)


FOUND = "q_block long, query_id long, query_key long, vec_id long, score long, evaluated long"


def searcher(spec: TopK, shared):
    """Pairs of a block of rows and a block of queries to the best rows of each query, and one row without a candidate
    a query that counts its evaluations. The pairs of a block of rows come one after the other."""
    def search(batches):
        block, name, asked = None, None, {}
        for pdf in batches:
            for r in pdf.itertuples():
                if name != (r.dim, r.block):
                    block, name = Block(r, shared.value.get(r.dim, NO_PIVOTS), spec), (r.dim, r.block)
                if (r.q_dim, r.q_block) not in asked:
                    asked[r.q_dim, r.q_block] = Queries(r, spec.k)
                search_block(asked[r.q_dim, r.q_block], block, spec)
        for (_, q_block), q in asked.items():
            yield pd.DataFrame({"q_block": q_block, "query_id": q.ids[q.at], "query_key": q.keys[q.at], "vec_id": q.id, "score": q.score,
                                "evaluated": 0}).astype("Int64")
            none = pd.array([None] * len(q.ids), dtype="Int64")
            yield pd.DataFrame({"q_block": q_block, "query_id": q.ids, "query_key": q.keys, "vec_id": none, "score": none,
                                "evaluated": q.evaluated}).astype("Int64")
    return search


def query_key(vector: np.ndarray) -> int:
    """Tells queries of one id apart."""
    return xxhash.xxh3_64_intdigest(np.ascontiguousarray(vector).tobytes()) >> 1


def top_k(rows: DataFrame, is_query: Column, spec: TopK = TopK(), id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """Per query: query_id, rank, vec_id, score of its ``k`` best other rows."""
    good = rows.filter(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    good = good.select(F.col(id_col).cast("long").alias("id"), integers(F.col(vector_col), spec.scale).alias("v"),
                       F.coalesce(is_query, F.lit(False)).alias("asks"), F.size(vector_col).alias("dim"))
    n_rows = good.count()
    few = good.select("dim", "v").orderBy(F.xxhash64("id", "v")).limit(spec.sample).collect()
    sample: dict = {}
    for r in few:
        sample.setdefault(r["dim"], []).append(r["v"])
    pivots = {d: Pivots.of(np.array(vs, dtype=float).reshape(len(vs), d),
                           min(spec.pivots, ceil(spec.pivot_share * n_rows * len(vs) / len(few)))) for d, vs in sample.items()}
    sc = rows.sparkSession.sparkContext
    shared = sc.broadcast(pivots)  # at most ``pivots`` rows a length, of ``sample`` rows in all
    blocks = stored(good.select("id", "v", "dim").mapInPandas(packer(spec.block_rows), ROWS), "topk-rows")
    asked = good.filter("asks").select("id", "v", "dim").distinct()
    queries = stored(asked.mapInPandas(query_packer(spec, shared), ASKED), "topk-queries")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc_nulls_last(), "vec_id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(order))

    def look(rows: DataFrame, asked: DataFrame) -> DataFrame:
        # every pair of a block of rows and one of queries; a condition by difference, as rows dealt by length would meet in one task
        pairs = rows.join(asked.hint("shuffle_replicate_nl"), F.col("dim") - F.col("q_dim") == 0)
        return pairs.mapInPandas(searcher(spec, shared), FOUND)

    nothing = [F.lit(None).cast("array<string>").alias("r_keys"), F.lit(None).cast("array<long>").alias("r_scores")]
    n_blocks, first = blocks.agg(F.count(F.lit(1)), F.min("block")).first()
    at_first = F.col("block") == F.lit(first)  # one block, or blocks of the same rows
    start = look(blocks.filter(at_first), queries.select("*", *nothing))
    if n_blocks > 1:  # one block alone has nothing to learn from another
        start = stored(start, "topk-start")
        mark = F.struct(F.concat_ws(":", "query_id", "query_key").alias("key"), "score")
        known = (ranked(start).filter((F.col("rank") == spec.k) & F.col("vec_id").isNotNull())
                 .groupBy("q_block").agg(F.collect_list(mark).alias("r"))  # at most the queries of one block
                 .select("q_block", F.col("r.key").alias("r_keys"), F.col("r.score").alias("r_scores")))
        more = stored(queries.join(known, "q_block", "left"), "topk-asked")
        n_asked = asked.count()
        rest = blocks.filter(~at_first).repartition(min(n_blocks, max(4 * sc.defaultParallelism, n_blocks // 64)), "block")
        start = start.unionByName(look(rest, more.coalesce(max(1, n_asked // spec.asked_rows))))
    total = F.sum("evaluated").over(Window.partitionBy("query_id", "query_key"))
    return (ranked(start).withColumn("evaluated", total)
            .filter((F.col("rank") <= spec.k) & F.col("vec_id").isNotNull())
            .select("query_id", "rank", "vec_id", "score", "evaluated"))
