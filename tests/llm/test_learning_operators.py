"""Importance resampling, centroid clustering and approximate search against brute force."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from leadlens.llm import bucket_resample as B
from leadlens.llm import centroid_clusters as C
from leadlens.llm import learned_search as L
from pyspark.sql import functions as F

VECTORS = "vec_id long, embedding array<float>, label int"
DOCS = "doc_id long, text string, bucket int, w string, rank int"
ITEMS = "item_id long, text string"


# ---------------------------------------------------------------- importance resampling

def texts(rng, n):
    words = ["the", "The", "a", "naïve", "œuvre", "x" * 300, "Ж", "42", "don't", "ÄB", "İ", "k", "à", "…"]
    out = [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(n)]
    return out + [None, "", " \n", "one", " x y", "a--b__c", out[0], out[1], "w " * 30000]


def features(text, n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return w, [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in range(1, n + 1) for i in range(len(w) - k + 1)]


@pytest.mark.parametrize("ngram,block", [(2, 1 << 20), (2, 100), (3, 700), (1, 1)])
def test_resampling_by_hand(spark, ngram, block):
    rng = random.Random(ngram)
    docs = [(i, t, 1, "w", 2) for i, t in enumerate(texts(rng, 60))]
    docs += [docs[3], (7, docs[4][1], 0, None, None), (None, docs[5][1], 0, None, None)]
    items = [(i, t) for i, t in enumerate(texts(rng, 10))]
    spec = B.Resample(ngram=ngram, block_bytes=block)
    got = B.resample(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), spec).collect()
    s, t = (Counter(b for r in rows for b in features(r[1], ngram)[1]) for rows in (docs, items))
    s_all, t_all = sum(s.values()), sum(t.values())
    exp = []
    for i, text, *_ in docs:
        w, f = features(text, ngram)
        g = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in f]
        weight = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        exp.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)))
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r.n_words) for r in got) == Counter(exp)
    able = sorted((-r[3], r[0] is None, r[0] or 0) for r in exp if r[4] >= 20)
    drawn = able[:25 * len(able) // 100]
    assert sorted((r.rank, -r.score, r.doc_id is None, r.doc_id or 0) for r in got if r.rank is not None) == \
        [(k + 1, *d) for k, d in enumerate(drawn)]


def test_resampling_of_empty_tables(spark):
    none, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b " * 20, 0, "", 0)] * 4, DOCS)
    assert B.resample(none, items).count() == 0
    assert [r.rank for r in B.resample(some, items).orderBy(F.col("rank").asc_nulls_last()).collect()] == [1, None, None, None]


def test_checksums_of_joined_texts():
    rng = random.Random(2)
    a, b = ([rng.randbytes(rng.choice([0, 1, 7, 300])) for _ in range(200)] for _ in range(2))
    crc = lambda x: np.array([zlib.crc32(v) for v in x], dtype=np.uint32)
    got = B.appended(crc(a), crc(b), np.array([len(x) for x in b]))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b)]


# ---------------------------------------------------------------- centroid clustering

def lloyd(vectors, k, rounds, seed=1):
    """vectors: (id, integer components); (id, cluster, distance) of each and the centroids."""
    order = sorted(vectors, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    c = [list(v) for _, v in order[:k]]
    for t in range(rounds + 1):
        near = []
        for _, v in vectors:
            d, j = min((sum((x - y) ** 2 for x, y in zip(v, m)), j) for j, m in enumerate(c))
            near.append((j, d))
        if t < rounds:
            for j in range(len(c)):
                mine = [v for (_, v), (g, _) in zip(vectors, near) if g == j]
                if mine:
                    c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, j, d) for (i, _), (j, d) in zip(vectors, near)], c


def cluster_rows(seed, n=300, dim=6, centres=5):
    rng = random.Random(seed)
    mid = [[rng.uniform(-2, 2) for _ in range(dim)] for _ in range(centres)]
    rows = [(i, [m + rng.gauss(0, 0.3) for m in rng.choice(mid)], 0) for i in range(n)]
    rows += [(900 + i, [0.5] * dim, 0) for i in range(60)] + [rows[0], rows[1]]  # ties, repeated rows
    return rows + [(2000, None, 0), (2001, [0.1, None] + [0.0] * (dim - 2), 0), (2002, [float("nan")] * dim, 0),
                   (2003, [float("-inf")] * dim, 0), (2004, [0.1] * (dim + 1), 0), (2005, [], 0), (None, [0.5] * dim, 0)]


@pytest.mark.parametrize("k,rounds,history,block", [(4, 6, 64, 50), (7, 9, 2, 4096), (400, 2, 64, 100), (1, 3, 64, 64)])
def test_clusters_by_hand(spark, k, rounds, history, block):
    df = spark.createDataFrame(cluster_rows(k), VECTORS).withColumn("cluster", F.lit(9)).withColumn("id", F.lit("x")).repartition(3)
    spec = C.Clusters(k=k, rounds=rounds, scale=64, dim=6, block_rows=block, history=history)
    got = C.report(df, spec).collect()
    rows = [(r.vec_id, [math.floor(64 * x) for x in r.embedding]) for r in df.collect()
            if r.vec_id is not None and r.embedding is not None and len(r.embedding) == 6
            and all(x is not None and math.isfinite(x) for x in r.embedding)]
    exp, c = lloyd(rows, k, rounds)
    assert Counter((r.vec_id, r.cluster, r.distance) for r in got) == Counter(exp)
    per = Counter()
    for _, j, d in exp:
        per[j] += d
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    assert all(r.cluster_inertia == per[r.cluster] and r.inertia == sum(per.values()) and r.centroid_sha256 == sha[r.cluster] for r in got)


def test_clusters_of_an_empty_table(spark):
    assert C.report(spark.createDataFrame([], VECTORS)).count() == 0
    assert C.report(spark.createDataFrame([(1, None, 0)], VECTORS)).count() == 0


def test_bounds_hold_and_spare_distances(spark):
    """In every round each bound holds, displacement is never more than the drifts add up to and often less, and on
    rows that have settled hardly a distance is evaluated."""
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(m, 20, (200, 8)) for m in rng.uniform(-200, 200, (10, 8))]).astype(np.int64)
    history = [v[rng.permutation(len(v))[:12]]]
    b, evaluated = C.fresh(v, history[0])
    counts, shorter = [evaluated], 0
    for t in range(1, 15):
        sums, n = C.totals(v, b.own, 12)
        history.append(np.where(n[:, None] > 0, sums // np.maximum(n, 1)[:, None], history[-1]))
        b, evaluated = C.renewed(v, b, history, 64)
        counts.append(evaluated)
        true = np.stack([np.sqrt(C.squared(v, c).astype(float)) for c in history[-1]], axis=1)
        way = C.displacement(history, 0)
        assert (b.lower - way[b.lower_at, np.arange(12)] <= true + 1e-9).all()
        assert (b.upper + way[b.upper_at, b.own] >= true[np.arange(len(v)), b.own] - 1e-9).all()
        assert (true[np.arange(len(v)), b.own] == true.min(axis=1)).all()
        drift = np.cumsum([np.sqrt(((y - x) ** 2).sum(axis=1)) for x, y in zip(history, history[1:])][::-1], axis=0)[::-1]
        assert (way[:-1] <= drift + 1e-9).all()
        shorter += int((way[:-1] < drift - 1e-6).sum())
    assert shorter > 0 and counts[-1] < 0.02 * counts[0]


def test_settled_blocks_evaluate_nothing(spark):
    rows = [(i, [float(i % 3) * 9, float(i % 7) / 100], 0) for i in range(500)]
    out, fitted = C.cluster(spark.createDataFrame(rows, VECTORS), C.Clusters(k=3, rounds=8, dim=2))
    assert fitted.rows == 500 and fitted.evaluated[0] == 1500 and len(fitted.evaluated) == 9
    assert fitted.evaluated[-1] < 500 and out.count() == 500


# ---------------------------------------------------------------- approximate search

def true_scores(rows, queries):
    out = {}
    for i, q in queries:
        s = []
        for j, v in rows:
            if j != i and len(v) == len(q):
                total = 0.0
                for a, b in zip(q, v):
                    total += a * b
                s.append((-total, j))
        out[i] = sorted(s)
    return out


def searchable(df):
    return [(r.vec_id, list(r.embedding)) for r in df.collect() if r.vec_id is not None and r.embedding is not None
            and all(x is not None and math.isfinite(x) for x in r.embedding) and any(r.embedding)]


def test_search_with_all_parts_is_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(5)], 0) for i in range(700)]
    rows += [(1000 + i, [0.5] * 5, 0) for i in range(90)]  # ties
    rows += [(2000, None, 0), (2020, [0.0] * 5, 0), (2040, [float("nan")] * 5, 0), (2060, [1.0, None, 0.0, 0.0, 0.0], 0),
             (2080, [0.25, 0.5], 0), (2081, [0.5, 0.5], 0), (None, [9.0] * 5, 0), (2100, [], 0), (2120, [1e-30, 0.0, 1e30], 0), (2121, [1.0, 1.0, 1.0], 0)]
    df = spark.createDataFrame(rows + [rows[0], rows[21]], VECTORS).withColumn("part", F.lit(1)).withColumn("ids", F.lit("x")).repartition(4)
    routers = {}
    spec = L.Learned(k=7, parts=6, recall=1.1, block_rows=60, query_rows=9, fit_rows=600)
    got = L.search(df, F.col("vec_id") % 20 == 0, spec, routers=routers).collect()
    assert routers[5].parts == 6 and routers[5].probes == 6
    good = searchable(df)
    true = true_scores(good, {(i, tuple(v)) for i, v in good if i % 20 == 0})
    exp = {(i, k + 1, j, -s) for i, found in true.items() for k, (s, j) in enumerate(found[:7])}
    assert {tuple(r) for r in got} == exp and len(got) == len(exp)


def recall_of(got, true, k):
    """Rows found that are at least as near as the true k-th, and whether all scores are the rows' own."""
    hit = all_ = 0
    for i, found in true.items():
        mine = [r for r in got if r.query_id == i]
        score = {j: -s for s, j in found}
        assert all(r.score == score[r.vec_id] for r in mine)
        assert [r.rank for r in sorted(mine, key=lambda r: (-r.score, r.vec_id))] == list(range(1, len(mine) + 1))
        edge = -found[min(k, len(found)) - 1][0]
        hit += sum(r.score >= edge for r in mine)
        all_ += min(k, len(found))
    return hit / all_


def test_few_parts_serve_rows_in_groups(spark):
    rng = np.random.default_rng(5)
    mid = rng.normal(0, 1, (24, 16))
    v = np.concatenate([m + rng.normal(0, 0.25, (100, 16)) for m in mid])[rng.permutation(2400)]
    df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], VECTORS)
    routers = {}
    got = L.search(df, F.col("vec_id") % 60 == 0, L.Learned(k=10, parts=12, fit_rows=1200, block_rows=100), routers=routers).collect()
    good = searchable(df)
    assert routers[16].parts == 12 and routers[16].probes <= 6
    assert recall_of(got, true_scores(good, [(i, x) for i, x in good if i % 60 == 0]), 10) >= 0.9


def test_recall_on_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = L.search(df, F.col("vec_id") % 20 == 0).collect()
    good = searchable(df)
    assert recall_of(got, true_scores(good, [(i, x) for i, x in good if i % 20 == 0]), 20) >= 0.9


def test_parts_are_balanced_and_follow_the_graph():
    rng = np.random.default_rng(6)
    v = np.concatenate([rng.normal(m, 0.1, (100, 3)) for m in np.eye(3) * 3])
    graph = L.nearest(v, np.arange(300), v, 8)
    part = L.balanced_parts(graph, 3, rng)
    assert np.bincount(part).max() <= 105 and (part[graph] == part[:, None]).mean() > 0.9


def test_approximate_search_of_an_empty_table(spark):
    assert L.search(spark.createDataFrame([], VECTORS), F.lit(True)).count() == 0
    one = spark.createDataFrame([(20, [1.0, 2.0], 0)], VECTORS)
    assert L.search(one, F.lit(True)).count() == 0
