"""Boosted trees: a tree by hand, one block against many, missing values, penalties, early stopping."""
import math

import numpy as np
import pandas as pd
import pytest

from leadlens.operators import boosting as B
from pyspark.sql import functions as F

SCHEMA = "group int, part int, fold int, y int, uid long, x double, z double, c__idx double"


def layout(num=("x",), cat=(), cuts=None, sizes=None):
    return B.Layout(list(num), list(cat), {c: np.array(v, dtype=float) for c, v in (cuts or {"x": [1, 2, 3]}).items()}, sizes or {})


def rows_of(codes, y, part=None, fold=None):
    n = len(y)
    return B.Rows(np.array(codes, dtype=np.int32).reshape(n, -1), np.array(y, dtype=np.int8),
                  np.array(part or [0] * n, dtype=np.int8), np.array(fold or [0] * n, dtype=np.int16), np.arange(n, dtype=np.int64) * 7919)


def test_tree_by_hand():
    """Six rows, gradients ±1/2 and hessians 1/4 at margin 0: the cut after code 1 parts two negatives from the rest."""
    rows = rows_of([1, 1, 2, 2, 3, 3], [0, 0, 1, 1, 1, 0])
    task = B.Task(0, 0, {"max_depth": 1, "learning_rate": 0.5, "reg_lambda": 1.0, "min_child_weight": 0.1}, 1)
    t = B.grow_in_block(rows, layout(), task).trees[0]
    # left: G = 1, H = 1/2; right: G = -1, H = 1; all: G = 0, H = 3/2
    assert (t.feature[1], t.code[1]) == (0, 1)
    assert t.gain[1] == pytest.approx(1 / 1.5 + 1 / 2 - 0)
    assert t.value[2] == pytest.approx(-1 / 1.5 * 0.5) and t.value[3] == pytest.approx(1 / 2 * 0.5)
    assert t.cover[1] == pytest.approx(1.5) and t.cover[2] == pytest.approx(0.5)


def test_missing_rows_go_where_they_gain():
    """Missing rows are positive like the high codes: they go right; like the low ones: left."""
    task = B.Task(0, 0, {"max_depth": 1, "min_child_weight": 0.1}, 1)
    high = B.grow_in_block(rows_of([0, 0, 1, 1, 3, 3], [1, 1, 0, 0, 1, 1]), layout(), task).trees[0]
    low = B.grow_in_block(rows_of([0, 0, 1, 1, 3, 3], [0, 0, 0, 0, 1, 1]), layout(), task).trees[0]
    assert not high.missing_left[1] and low.missing_left[1]
    only = B.grow_in_block(rows_of([0, 0, 2, 2], [1, 1, 0, 0]), layout(), task).trees[0]  # missing against present
    assert only.leaves(np.array([[0], [2]], dtype=np.int32), 1).tolist() == [2, 3]


def test_penalties_and_limits():
    codes, y = [1, 1, 2, 2, 3, 3], [0, 0, 1, 1, 1, 1]
    grow = lambda **p: B.grow_in_block(rows_of(codes, y), layout(), B.Task(0, 0, {"max_depth": 2, "min_child_weight": 0.1, **p}, 1)).trees[0]
    plain = grow()
    assert plain.feature[1] == 0
    assert abs(grow(reg_lambda=10.0).value[2]) < abs(plain.value[2])
    assert grow(reg_alpha=0.4).value[2] == pytest.approx(-(1 - 0.4) / 1.5 * 0.3)  # G of the two negatives is 1
    assert grow(reg_alpha=5.0).feature[1] == -1
    assert grow(min_child_weight=1).feature[1] == -1  # no child has a hessian of 1 on both sides
    assert grow(gamma=100.0).feature[1] == -1
    weighted = B.grow_in_block(rows_of(codes, y), layout(), B.Task(0, 0, {"max_depth": 1, "min_child_weight": 0.1}, 1, pos_weight=3.0)).trees[0]
    assert weighted.cover[3] == pytest.approx(4 * 3 * 0.25)


def test_pruning_spares_a_weak_split_above_a_strong_one():
    t = B.Tree.empty(2)
    t.feature[[1, 2]], t.gain[[1, 2]] = 0, [0.5, 9.0]
    assert t.pruned(1.0).feature[[1, 2]].tolist() == [0, 0]
    t.gain[2] = 0.7
    assert t.pruned(1.0).feature[[1, 2]].tolist() == [-1, -1]


def test_one_slot_against_the_rest():
    lay = layout((), ("c",), {}, {"c": 4})
    rows = rows_of([0, 1, 1, 2, 2, 3, 4], [0, 1, 1, 0, 0, 0, 0])
    t = B.grow_in_block(rows, lay, B.Task(0, 0, {"max_depth": 1, "min_child_weight": 0.1}, 1)).trees[0]
    assert t.code[1] == 1 and t.leaves(rows.codes, 0).tolist() == [3, 2, 2, 3, 3, 3, 3]


def test_average_precision_by_hand():
    counts = pd.DataFrame({"idx": [5, 3, 1], "g": [1, 0, 1], "h": [0, 2, 0]})
    assert B.average_precision(counts) == pytest.approx(0.5 * 1 + 0.5 * 0.5)
    assert math.isnan(B.average_precision(counts.assign(g=0)))


def test_stopping_rule():
    assert not B.finished([0.1, 0.2, 0.2], 2) and B.finished([0.1, 0.2, 0.2, 0.2], 2)
    assert not B.finished([0.1] * 9, None) and B.best_round([math.nan, 0.3, 0.3]) == 1 and B.best_round([]) == 0


def data(spark, n=900, groups=1, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        x, z, c = rng.integers(0, 40, n), rng.normal(0, 1, n), rng.integers(0, 5, n)
        p = 1 / (1 + np.exp(-(0.15 * (x - 20) + 1.2 * (c == 2) - 0.8 * (z > 0.5))))
        for i in range(n):
            rows.append((g, int(rng.choice([0, 0, 0, 1, 2])), int(i % 3), int(rng.random() < p[i]), g * n + i,
                         None if i % 11 == 0 else float(x[i]), float(z[i]), float(c[i])))
    df = spark.createDataFrame(rows, SCHEMA)
    return df.unionByName(df.limit(5).withColumn("y", F.lit(None).cast("int")))


def layouts_of(df, groups):
    cuts = B.numeric_cuts(df.filter("part = 0"), ["x", "z"], "group", max_bins=32)
    return {g: B.Layout(["x", "z"], ["c"], cuts[g], {"c": 5}) for g in range(groups)}


def test_many_blocks_give_the_same_trees_as_one(spark):
    df = data(spark, groups=2)
    lay = layouts_of(df, 2)
    params = {"max_depth": 3, "learning_rate": 0.3, "subsample": 0.8, "colsample_bytree": 0.7, "reg_alpha": 0.1, "gamma": 0.2}
    tasks = [B.Task(0, 0, params, 5, 1.5, 1, patience=3), B.Task(1, 1, {**params, "max_depth": 2}, 4, 1.0, 2, fold=1, watch=False),
             B.Task(2, 0, params, 3, 2.0, 3, everything=True), B.Task(3, 1, params, 4, fold=0, watch=False, keep=False)]
    one = B.pack(df, lay, 5000)
    many = B.pack(df.repartition(5), lay, 130)
    assert set(one.n_blocks.values()) == {1} and min(many.n_blocks.values()) > 5
    a, b = B.fit(one, tasks), B.fit(many, tasks, refresh=2)
    for t in tasks:
        assert a[t.model].history == b[t.model].history, t
        assert a[t.model].packed() == b[t.model].packed(), t
    assert len(a[0].history) == len(a[0].trees) and len(a[1].history) == 1 and a[2].history == [] and a[3].trees == []
    again = B.fit(B.pack(df.repartition(3), lay, 5000), tasks)
    assert all(again[m].packed() == a[m].packed() for m in a)


def test_learning_beats_chance_and_stops_by_itself(spark):
    df = data(spark, 3000)
    lay = layouts_of(df, 1)
    b = B.fit(B.pack(df, lay), [B.Task(0, 0, {"max_depth": 3, "learning_rate": 0.2}, 2000, patience=20)])[0]
    assert len(b.trees) < 200 and len(b.trees) == b.best + 1 + 20 and len(b.used()) == b.best + 1
    pdf = df.filter("part = 2 and y is not null").toPandas()
    p = b.probabilities(lay[0].codes(pdf))
    counts = pd.DataFrame({"idx": p, "g": pdf["y"], "h": 1 - pdf["y"]})
    assert B.average_precision(counts) > 1.3 * pdf["y"].mean() and b.history[b.best] > 1.3 * pdf["y"].mean()


def test_cuts(spark):
    rows = [(0, float(i % 7)) for i in range(100)] + [(1, float(i)) for i in range(1000)] + [(1, 5.0)] * 1000 + [(0, None)]
    cuts = B.numeric_cuts(spark.createDataFrame(rows, "group int, x double").repartition(3), ["x"], "group", max_bins=10)
    assert cuts[0]["x"].tolist() == [float(i) for i in range(7)]
    # 2000 rows: the hot value passes 200..1000 at once
    assert cuts[1]["x"].tolist() == [5.0, 199.0, 399.0, 599.0, 799.0, 999.0]


def test_empty_data(spark):
    df = spark.createDataFrame([], SCHEMA)
    m = B.pack(df, {})
    assert m.n_blocks == {}
    assert B.fit(m, []) == {}


def test_a_group_of_many_rows_is_one_block(spark):
    """More rows than the former limit of 65,536 and more models than tasks: one block, and trees as by level."""
    n = 70_000
    df = spark.range(n).selectExpr("0 as `group`", "int(id % 7 = 0) as part", "int(id % 3) as fold",
                                   "int(pmod(xxhash64(id), 40) < id % 40) as y", "id as uid", "double(id % 40) as x",
                                   "double(if(id % 5 = 0, null, pmod(hash(id), 50))) as z", "double(id % 6) as c__idx")
    lay = layouts_of(df.filter("uid < 5000"), 1)
    whole, dealt = B.pack(df, lay), B.pack(df, lay, 20_000)
    assert whole.n_blocks == {0: 1} and dealt.n_blocks[0] > 3
    tasks = [B.Task(m, 0, {"max_depth": 3, "subsample": 0.7, "colsample_bytree": 0.8, "gamma": 1.0}, 2, 1.5, m, fold=m) for m in range(3)]
    a, b = B.fit(whole, tasks), B.fit(dealt, tasks)
    assert all(a[t.model].packed() == b[t.model].packed() and a[t.model].history == b[t.model].history for t in tasks)
    assert B.rows_a_block(B.WHOLE_ROWS + 1, lay[0]) == B.BLOCK_ROWS
    assert B.rows_a_block(B.WHOLE_ROWS, B.Layout(list("abcdefghi"), [], {c: np.zeros(1) for c in "abcdefghi"}, {})) == B.BLOCK_ROWS


def test_rows_of_equal_codes_are_grown_as_one(monkeypatch):
    """Many rows of few codes: each round works on the codes, the models of a block take the hash of a round once, and trees
    and scores are those of the rows one by one."""
    rng = np.random.default_rng(2)
    n, lay = 20_000, layout(("x",), "c", {"x": range(30)}, {"c": 6})
    rows = rows_of(np.stack([rng.integers(0, 31, n), rng.integers(0, 7, n)], axis=1), rng.integers(0, 2, n),
                   list(rng.integers(0, 3, n)), list(rng.integers(0, 2, n)))
    tasks = [B.Task(m, 0, {"max_depth": 4, "subsample": 0.7, "colsample_bytree": 0.8, "gamma": 0.1}, 3, 1.5, 5, fold=m % 2) for m in range(4)]
    added, hashed, sums, mixed = [], [], B.Histograms.sums, B.mixed
    monkeypatch.setattr(B.Histograms, "sums", lambda self, at, *x: added.append(len(at)) or sums(self, at, *x))
    monkeypatch.setattr(B, "mixed", lambda *x: hashed.append(x[1:]) or mixed(*x))
    shared = B.Shared(rows, lay)
    models = [B.rounds_in_block(shared, t) for t in tasks]
    for _ in range(3):
        got = [next(m) for m in models]
    assert max(added) <= 31 * 7 and len(hashed) == 3
    for task, b in zip(tasks, got):
        margin = np.zeros(n)
        for rnd, tree in enumerate(b.trees):
            at, g, h = B.gradients(rows, margin, task, rnd)
            again, open_ = B.Tree.empty(4), np.array([1])
            for depth in range(4):
                hist = B.histogram(rows.codes[at], again.leaves(rows.codes[at], 1), open_, g, h, lay)
                open_ = B.place(again, open_, B.best_splits(*hist, lay, task, B.allowed_splits(lay, task, rnd)), task, depth == 3)
            assert all(np.array_equal(getattr(again.pruned(0.1), f), getattr(tree, f)) for f in B.TREE_FIELDS)
            margin += again.value[again.leaves(rows.codes, 1)]
            assert b.history[rnd] == B.average_precision(B.watched_counts(rows, margin, task))
        assert np.array_equal(b.margins(rows.codes), margin)


def test_a_block_may_hold_more_rows_than_before():
    """1.2 million rows of seven features, which grew level by level over blocks."""
    assert B.rows_a_block(1_200_000, layout(tuple("abcdefg"), (), {c: [1] for c in "abcdefg"})) == 1_200_000


def test_alike_of_many_wide_features():
    codes = np.random.default_rng(3).integers(0, 5, (500, 12)).astype(np.int32)
    codes = np.concatenate([codes, codes[:100]])
    lay = layout((), tuple(map(str, range(12))), {}, {str(i): 99_999 for i in range(12)})
    first, at = B.alike(codes, lay)
    assert len(first) == len(np.unique(codes, axis=0)) and np.array_equal(codes[first][at], codes)


@pytest.mark.parametrize("sizes", [(3, 4, 5), (90, 100, 7), (5000, 2, 3)])
def test_joined_features_give_the_plain_histogram(sizes):
    """All features joined, some, none of the wide one; whole trees by plain histograms of all open nodes."""
    rng = np.random.default_rng(1)
    n, lay = 30_000, layout((), "abc", {}, dict(zip("abc", sizes)))
    codes = np.stack([rng.integers(0, k + 1, n) for k in sizes], axis=1).astype(np.int32)
    g, h = rng.integers(-1000, 1000, n).astype(float), rng.integers(0, 1000, n).astype(float)
    nodes, node = np.array([4, 5, 6]), rng.integers(4, 8, n)
    at = np.flatnonzero(node < 7)
    plain = B.histogram(codes, node, nodes, g, h, lay)
    assert np.array_equal(B.Histograms(codes, lay).sums(at, node[at] - 4, 3, g[at], h[at]), np.stack(plain))
    rows = B.Rows(codes, (codes[:, 0] % 3 == rng.integers(0, 3, n)).astype(np.int8), rng.integers(0, 2, n).astype(np.int8),
                  np.zeros(n, np.int16), np.arange(n, dtype=np.int64) * 7919)
    task = B.Task(0, 0, {"max_depth": 4, "subsample": 0.8, "min_child_weight": 3}, 2)
    margin = np.zeros(n)
    for rnd, tree in enumerate(B.grow_in_block(rows, lay, task).trees):
        at, g, h = B.gradients(rows, margin, task, rnd)
        again, open_ = B.Tree.empty(4), np.array([1])
        for depth in range(4):
            hist = B.histogram(codes[at], again.leaves(codes[at], 0), open_, g, h, lay)
            open_ = B.place(again, open_, B.best_splits(*hist, lay, task, B.allowed_splits(lay, task, rnd)), task, depth == 3)
        assert all(np.array_equal(getattr(again, f), getattr(tree, f)) for f in B.TREE_FIELDS)
        margin += again.value[again.leaves(codes, 0)]
