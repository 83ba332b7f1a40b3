"""Promotion gate truth table, including NaN, NULL live and the exact tolerance edge."""
import math

from leadlens.operators.registry import promotion_gate


def _gate(spark, rows):
    cand = spark.createDataFrame([(s, c) for s, c, _ in rows], "segment string, metric_value double")
    live = spark.createDataFrame([(s, l) for s, _, l in rows if l != "absent"], "segment string, metric_value double")
    return {r["segment"]: r for r in promotion_gate(cand, live).collect()}


def test_gate_truth_table(spark):
    g = _gate(spark, [
        ("below", 0.9, 2.0), ("nan", float("nan"), None), ("null", None, 1.5),
        ("boot", 1.2, "absent"), ("nulllive", 1.2, None), ("nanlive", 1.3, float("nan")),
        ("ok", 1.9, 2.0), ("edge", 1.5, 1.65), ("regress", 1.4, 2.0),
    ])
    assert (g["below"]["promoted"], g["below"]["reason_code"]) == (False, "below_min")
    assert (g["nan"]["promoted"], g["nan"]["reason_code"]) == (False, "below_min")
    assert (g["null"]["promoted"], g["null"]["reason_code"]) == (False, "below_min")
    for s in ("boot", "nulllive", "nanlive"):
        assert (g[s]["promoted"], g[s]["reason_code"], g[s]["live"]) == (True, "bootstrap", -1.0)
    assert (g["ok"]["promoted"], g["ok"]["reason_code"]) == (True, "no_regression")
    # 1.65 - 0.15 is 1.4999999999999998 in floating point, so 1.5 passes exactly at the edge
    assert g["edge"]["promoted"] is (1.5 >= 1.65 - 0.15)
    assert (g["regress"]["promoted"], g["regress"]["reason_code"]) == (False, "regression")
    assert g["regress"]["reason"] == "lift_A 1.400 against 2.000 live, tolerance 0.15: beyond"
    assert "does not reach" in g["null"]["reason"]
    assert not math.isnan(g["ok"]["candidate"])
