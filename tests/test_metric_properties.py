"""Metric identities and property-based comparison with brute force (ties included)."""
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from leadlens.operators import rank as R


def _df(spark, y, s):
    pdf = pd.DataFrame({"id": np.arange(len(y)), "y": np.asarray(y, dtype=int), "score": np.asarray(s, dtype=float)})
    return spark.createDataFrame(pdf).repartition(3)


def _ap_auc(spark, y, s):
    c = R.distinct_score_curve(_df(spark, y, s), num_partitions=3)
    return R.average_precision(c).collect()[0][0], R.roc_auc(c).collect()[0][0]


def test_perfect_and_reversed_ranking(spark):
    y = [1] * 20 + [0] * 80
    s = list(np.linspace(1, 0, 100))
    ap, auc = _ap_auc(spark, y, s)
    assert ap == pytest.approx(1.0) and auc == pytest.approx(1.0)
    ap_r, auc_r = _ap_auc(spark, y, [-v for v in s])
    assert auc_r == pytest.approx(0.0) and ap_r == pytest.approx(np.mean(
        [(k + 1) / (80 + k + 1) for k in range(20)]))


def test_all_tied_scores(spark):
    y = [1, 0, 0, 1, 0, 0, 0, 1]
    ap, auc = _ap_auc(spark, y, [0.5] * len(y))
    assert auc == pytest.approx(0.5) and ap == pytest.approx(3 / 8)


def _brute(y, s):
    y, s = np.asarray(y), np.asarray(s, dtype=float)
    order = np.argsort(-s, kind="mergesort")
    ys, ss = y[order], s[order]
    idx = np.r_[np.where(np.diff(ss))[0], len(ss) - 1]
    tps = np.cumsum(ys)[idx]
    fps = idx + 1 - tps
    P, N = tps[-1], fps[-1]
    ap = np.sum(np.diff(np.r_[0, tps / P]) * (tps / (tps + fps)))
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    return ap, auc


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=4, max_size=60))
def test_ap_auc_match_brute_force(spark, pairs):
    y = [p[0] for p in pairs]
    s = [p[1] / 3 for p in pairs]  # heavy ties
    if 0 < sum(y) < len(y):
        ap, auc = _ap_auc(spark, y, s)
        bap, bauc = _brute(y, s)
        assert ap == pytest.approx(bap, abs=1e-12) and auc == pytest.approx(bauc, abs=1e-12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5)), min_size=1, max_size=80),
       st.integers(1, 7))
def test_grouped_rank_matches_sort(spark, rows, parts):
    pdf = pd.DataFrame({"id": np.arange(len(rows)), "g": [r[0] for r in rows],
                        "score": [float(r[1]) for r in rows]})
    rk = R.running_totals(spark.createDataFrame(pdf), [R.F.col("score").desc(), R.F.col("id").asc()], ["g"],
                          num_partitions=parts)
    got = rk.frame.toPandas()
    for g, part in pdf.groupby("g"):
        exp = part.sort_values(["score", "id"], ascending=[False, True], kind="mergesort")["id"].tolist()
        assert got[got.g == g].sort_values("rank")["id"].tolist() == exp
        assert rk.counts[(g,)] == len(part)
