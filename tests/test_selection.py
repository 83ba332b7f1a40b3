"""Distributed selection against numpy: ties, wide ranges, small groups, missing scores; no row is moved."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import DataFrame

from leadlens.operators import rank as R
from leadlens.sources import fixtures as fx

from conftest import SF_SMALL

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]


def frames():
    r = np.random.RandomState(11)
    yield "continuous", r.normal(size=5000)
    yield "ties", np.round(r.normal(size=5000), 1)
    yield "one value holds most", np.where(r.rand(5000) < 0.7, 0.25, r.rand(5000))
    yield "wide", np.exp(r.uniform(-600, 600, 3000)) * r.choice([-1, 1], 3000)
    yield "constant", np.full(700, 3.5)
    yield "few", np.array([4.0, -1.0])
    yield "one", np.array([2.0])
    yield "infinite", np.array([-np.inf, 0.0, 1.0, np.inf, np.inf])


@pytest.mark.parametrize("name,values", list(frames()), ids=lambda v: v if isinstance(v, str) else "")
def test_values_at_positions(spark, name, values):
    """Every step by counting alone (no row is fetched) and with the rest fetched."""
    df = spark.createDataFrame(pd.DataFrame({"score": values})).repartition(5)
    n = len(values)
    wanted = {0, n - 1, n // 2, n // 3, min(n - 1, n // 2 + 1)}
    expected = {p: float(np.sort(values)[p]) for p in wanted}
    for finish in (0, 50):
        assert R.select_at(df, "score", {(): wanted}, {(): n}, finish_rows=finish)[()] == expected


def test_quantiles_by_group(spark):
    r = np.random.RandomState(5)
    pdf = pd.DataFrame({"g": r.choice(["a", "b"], 4000, p=[0.95, 0.05]), "score": np.round(r.rand(4000), 2)})
    df = spark.createDataFrame(pdf)
    df = df.unionByName(spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("a", float("nan")), ("c", None)], "g string, score double"))
    for finish in (0, 100, 10_000):
        got = R.select_quantiles(df, "score", PROBS, ["g"], finish)
        assert set(got) == {("a",), ("b",), (None,)}
        for g in "ab":
            assert got[(g,)] == [float(np.quantile(pdf.loc[pdf["g"] == g, "score"], q)) for q in PROBS]
        assert got[(None,)] == [float(np.quantile([1.0, 3.0], q)) for q in PROBS]
    assert R.select_quantiles(df.limit(0), "score", PROBS, ["g"]) == {}


def test_cutoffs_bins_and_confusion_move_no_row(spark, monkeypatch):
    df = fx.scored_frame(spark, SF_SMALL)
    ranked = R.rank_by_score(df, group=["segmento"])
    plain = R.scored(df, ["segmento"])
    by_rank = R.confusion_at_top(ranked).collect()
    monkeypatch.setattr(DataFrame, "repartitionByRange", None)
    monkeypatch.setattr(DataFrame, "checkpoint", None)
    assert set(R.grade_thresholds(plain)) == {("main",), ("landing",)}
    assert sorted(R.confusion_at_top(plain).collect()) == sorted(by_rank)
    plan = R.qcut_bins(plain)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
