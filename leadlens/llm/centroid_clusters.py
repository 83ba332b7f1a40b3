"""Exact centroid clustering (Lloyd's rounds) with ns-bounds.

Components become integers ``floor(scale * x)``; centroids stay integer vectors, so every distance, sum and mean is exact
and the result does not depend on how the rows are dealt. Each vector keeps an upper bound of the distance to its own
centroid and a lower bound of the distance to every other one, each with the round in which it was last evaluated. The
history of all centroids is kept (``k`` vectors a round, a few kilobytes); a bound taken in round T is loosened by the
norm of the centroid's total displacement since T, which is never more than the sum of its drifts in between. Where the
loosened bounds leave a doubt, the own distance is evaluated first and then, exactly, the distances to those centroids
that could still be nearer. Bounds older than ``history`` rounds count as void, which bounds what is kept.

Vectors are packed into blocks with their bounds (6 bytes a centroid). A round is one pass without a shuffle: it reads
the blocks, writes them with new bounds into the shared folder and adds up each block's sums and counts, of which
``k * (dim + 1)`` numbers reach the driver for the new centroids. A finished round's table is dropped once the next one is
written, so two are on disk at a time and a lost executor costs part of one round.

Edge cases: vectors that are null, hold a null or non-finite component, have another length than ``dim`` or no id take no
part; rows that repeat an id are vectors of their own; equal distances go to the smaller centroid number; a centroid
without vectors stays where it is; with fewer vectors than ``k`` there are as many centroids as vectors; an empty table
gives an empty result; integer components beyond 2**27 raise an error (squares would leave 64 bits); only id and vector
are read, other columns cannot clash.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import hadoop_fs
from .common import by_value, ensure_session, scratch_path
from .topk_search import integers, usable

by_value(__name__)

LARGEST = 1 << 27
BLOCKS = ("ids binary, vectors binary, own binary, upper binary, upper_at binary, lower binary, lower_at binary, "
          "sums binary, counts binary, evaluated long")


@dataclass(frozen=True)
class Clusters:
    k: int = 16
    rounds: int = 3
    scale: int = 64
    dim: int = 64
    seed: int = 1
    block_rows: int = 4096
    history: int = 64


@dataclass
class Fitted:
    """Centroids by round, and the distances evaluated in each assignment (of ``rows * k``)."""
    history: list[np.ndarray]
    rows: int = 0
    evaluated: list[int] = field(default_factory=list)

    @property
    def centroids(self) -> np.ndarray:
        return self.history[-1]


@dataclass
class Bounds:
    own: np.ndarray       # number of the nearest centroid
    upper: np.ndarray     # at least the distance to it, as of round upper_at
    upper_at: np.ndarray
    lower: np.ndarray     # per centroid: at most the distance to it, as of round lower_at
    lower_at: np.ndarray

    def packed(self) -> dict[str, bytes]:
        return {name: getattr(self, name).tobytes() for name in ("own", "upper", "upper_at", "lower", "lower_at")}


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((v.astype(np.int64) - c) ** 2).sum(axis=1)


def below(x: np.ndarray) -> np.ndarray:
    """Single precision, rounded down."""
    y = x.astype(np.float32)
    return np.where(y > x, np.nextafter(y, np.float32(-np.inf)), y)


def fresh(v: np.ndarray, c: np.ndarray) -> tuple[Bounds, int]:
    """Bounds by evaluating everything."""
    d = np.stack([squared(v, x) for x in c], axis=1)
    own = d.argmin(axis=1).astype(np.int32)
    root = np.sqrt(d.astype(float))
    return Bounds(own, root[np.arange(len(v)), own], np.zeros(len(v), np.int16), below(root),
                  np.zeros(d.shape, np.int16)), d.size


def displacement(history: list[np.ndarray], first: int) -> np.ndarray:
    """Norm of the way from each earlier round's centroids to the last ones; infinite for rounds before ``first``."""
    out = np.stack([np.sqrt(((history[-1] - h) ** 2).sum(axis=1).astype(float)) for h in history])
    out[:first] = np.inf
    return out


def renewed(v: np.ndarray, b: Bounds, history: list[np.ndarray], keep: int) -> tuple[Bounds, int]:
    """Bounds and nearest centroids for the last centroids of ``history``; what the bounds settle is not evaluated."""
    t, c = len(history) - 1, history[-1]
    n, k = b.lower.shape
    rows = np.arange(n)
    way = displacement(history, max(0, t - keep))
    upper = b.upper + way[b.upper_at, b.own]
    lower = b.lower.astype(float) - way[b.lower_at, np.arange(k)]
    lower[rows, b.own] = np.inf
    slack = 1e-9 + 1e-12 * np.abs(c).max(initial=1) * np.sqrt(v.shape[1])  # rounding of the bounds
    doubt = np.flatnonzero(lower.min(axis=1, initial=np.inf) <= upper * (1 + 1e-12) + slack)
    if not len(doubt):
        return b, 0
    own, up, up_at, low, low_at = (x.copy() for x in (b.own, b.upper, b.upper_at, b.lower, b.lower_at))
    best = np.zeros(len(doubt), dtype=np.int64)
    for j in range(k):
        mine = own[doubt] == j
        best[mine] = squared(v[doubt[mine]], c[j])
    evaluated = len(doubt)
    root = np.sqrt(best.astype(float))
    low[doubt, own[doubt]], low_at[doubt, own[doubt]] = below(root), t
    near = lower[doubt] <= (root * (1 + 1e-12) + slack)[:, None]
    winner = own[doubt]
    for j in range(k):
        at = np.flatnonzero(near[:, j])
        if not len(at):
            continue
        d = squared(v[doubt[at]], c[j])
        evaluated += len(at)
        low[doubt[at], j], low_at[doubt[at], j] = below(np.sqrt(d.astype(float))), t
        wins = (d < best[at]) | ((d == best[at]) & (j < winner[at]))
        best[at[wins]], winner[at[wins]] = d[wins], j
    own[doubt], up[doubt], up_at[doubt] = winner, np.sqrt(best.astype(float)), t
    return Bounds(own, up, up_at, low, low_at), evaluated


def totals(v: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    sums = np.stack([v[own == j].sum(axis=0, dtype=np.int64) for j in range(k)])
    return sums, np.bincount(own, minlength=k).astype(np.int64)


def row(ids: bytes, v: np.ndarray, b: Bounds, k: int, evaluated: int) -> dict:
    sums, counts = totals(v, b.own, k)
    return {"ids": ids, "vectors": v.tobytes(), **b.packed(), "sums": sums.tobytes(), "counts": counts.tobytes(),
            "evaluated": evaluated}


def unpacked(r, dim: int, k: int) -> tuple[np.ndarray, Bounds]:
    n = len(r.ids) // 8
    v = np.frombuffer(r.vectors, dtype=f"i{len(r.vectors) // (n * dim)}").reshape(n, dim)
    return v, Bounds(np.frombuffer(r.own, np.int32), np.frombuffer(r.upper), np.frombuffer(r.upper_at, np.int16),
                     np.frombuffer(r.lower, np.float32).reshape(n, k), np.frombuffer(r.lower_at, np.int16).reshape(n, k))


def narrow(v: np.ndarray) -> np.ndarray:
    """The same integers in the fewest bytes."""
    most = int(np.abs(v).max(initial=0))
    if most > LARGEST:
        raise ValueError(f"a component of {most} cannot be squared and added up in 64 bits")
    return v.astype(np.int8 if most < 128 else np.int16 if most < 1 << 15 else np.int32)


def first_pass(spec: Clusters, start: np.ndarray):
    """Rows of (id, v) to blocks with bounds."""
    def block(ids: list, vectors: list) -> dict:
        v = narrow(np.array(vectors, dtype=np.int64))
        b, evaluated = fresh(v, start)
        return row(np.array(ids, dtype=np.int64).tobytes(), v, b, len(start), evaluated)

    def run(batches: Iterator[pd.DataFrame]):
        ids: list = []
        vectors: list = []
        for pdf in batches:
            ids += pdf["id"].tolist()
            vectors += pdf["v"].tolist()
            while len(ids) >= spec.block_rows:
                yield pd.DataFrame([block(ids[:spec.block_rows], vectors[:spec.block_rows])])
                ids, vectors = ids[spec.block_rows:], vectors[spec.block_rows:]
        if ids:
            yield pd.DataFrame([block(ids, vectors)])
    return run


def next_pass(spec: Clusters, history: list[np.ndarray]):
    def run(batches: Iterator[pd.DataFrame]):
        k = len(history[-1])
        for pdf in batches:
            for r in pdf.itertuples():
                v, b = unpacked(r, spec.dim, k)
                b, evaluated = renewed(v, b, history, spec.history)
                yield pd.DataFrame([row(r.ids, v, b, k, evaluated)])
    return run


def added(k: int, dim: int):
    """One task's sums and counts as rows of (centroid, position, value); position ``dim`` is the count, ``dim + 1`` of
    centroid 0 the evaluated distances."""
    def run(batches: Iterator[pd.DataFrame]):
        total = np.zeros((k, dim + 2), dtype=np.int64)
        for pdf in batches:
            for s, c, e in zip(pdf["sums"], pdf["counts"], pdf["evaluated"]):
                total[:, :dim] += np.frombuffer(s, np.int64).reshape(k, dim)
                total[:, dim] += np.frombuffer(c, np.int64)
                total[0, dim + 1] += e
        j, i = np.nonzero(total)
        yield pd.DataFrame({"j": j, "i": i, "value": total[j, i]})
    return run


def members(spec: Clusters, centroids: np.ndarray):
    """Blocks to rows of (vec_id, cluster, distance)."""
    def run(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            for r in pdf.itertuples():
                v, b = unpacked(r, spec.dim, len(centroids))
                yield pd.DataFrame({"vec_id": np.frombuffer(r.ids, np.int64), "cluster": b.own,
                                    "distance": squared(v, centroids[b.own])})
    return run


def cluster(rows: DataFrame, spec: Clusters = Clusters(), id_col: str = "vec_id",
            vector_col: str = "embedding") -> tuple[DataFrame, Fitted]:
    """Per vector its id, cluster and squared distance after ``rounds`` rounds and a last assignment; and the centroids."""
    spark = rows.sparkSession
    ensure_session(spark)
    good = rows.filter(usable(F.col(vector_col)) & (F.size(vector_col) == spec.dim) & F.col(id_col).isNotNull())
    good = good.select(F.col(id_col).cast("long").alias("id"), integers(F.col(vector_col), spec.scale).alias("v"))
    key = F.sha2(F.concat(F.lit(f"{spec.seed}:"), F.col("id").cast("string")), 256)
    start = good.select("v", key.alias("h"), "id").orderBy("h", "id", "v").limit(spec.k).collect()
    k = len(start)
    fitted = Fitted([np.array([r["v"] for r in start], dtype=np.int64).reshape(k, spec.dim)])
    work, held = good.mapInPandas(first_pass(spec, fitted.centroids), BLOCKS) if k else None, None
    if work is None:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), fitted
    while True:
        path = scratch_path(spark, "clusters")
        work.write.parquet(path)
        if held:
            fs, p = hadoop_fs(spark, held)
            fs.delete(p, True)
        held = path
        blocks = spark.read.schema(BLOCKS).parquet(path)
        total = np.zeros((k, spec.dim + 2), dtype=np.int64)
        part = blocks.select("sums", "counts", "evaluated").mapInPandas(added(k, spec.dim), "j int, i int, value long")
        for r in part.groupBy("j", "i").agg(F.sum("value").alias("value")).collect():
            total[r["j"], r["i"]] = r["value"]
        fitted.evaluated.append(int(total[0, spec.dim + 1]))
        fitted.rows = int(total[:, spec.dim].sum())
        if len(fitted.history) > spec.rounds:
            break
        counts = total[:, spec.dim:spec.dim + 1]
        fitted.history.append(np.where(counts > 0, total[:, :spec.dim] // np.maximum(counts, 1), fitted.centroids))
        work = blocks.mapInPandas(next_pass(spec, fitted.history), BLOCKS)
    out = blocks.select("ids", "vectors", "own", "upper", "upper_at", "lower", "lower_at")
    return out.mapInPandas(members(spec, fitted.centroids), "vec_id long, cluster int, distance long"), fitted


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def report(rows: DataFrame, spec: Clusters = Clusters(), id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia and the SHA-256 of its centroid."""
    out, fitted = cluster(rows, spec, id_col, vector_col)
    spark = rows.sparkSession
    per = {r["cluster"]: r["d"] for r in out.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # k rows
    facts = [(j, per.get(j, 0), sum(per.values()), digest(c)) for j, c in enumerate(fitted.centroids)]
    small = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(small), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                                                          "centroid_sha256")
