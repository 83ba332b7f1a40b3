"""Plan-shape checks for the scale properties the design relies on."""
from leadlens.operators import rank as R
from leadlens.sources import fixtures as fx

from conftest import SF_SMALL


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_rank_has_no_single_partition_step(spark):
    rk = R.rank_by_score(fx.scored_frame(spark, SF_SMALL), group=["segmento"])
    p = _plan(rk.frame)
    # reads the checkpoint and joins the broadcast offset table: no data shuffle at all
    assert "Exchange SinglePartition" not in p
    assert "Exchange hashpartitioning" not in p and "Exchange rangepartitioning" not in p
    assert "BroadcastExchange" in p


def test_inputs_are_not_dealt_anew(spark):
    from leadlens.operators.features import user_features
    for df in (fx.flat_events(spark, SF_SMALL), fx.event_shards(spark, SF_SMALL), fx.lead_table(spark, SF_SMALL)):
        assert "RoundRobinPartitioning" not in df._jdf.queryExecution().toString()
    plan = user_features(fx.feature_source(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "collect_set" not in plan


def test_curve_window_is_partitioned(spark):
    c = R.distinct_score_curve(fx.scored_frame(spark, SF_SMALL), group=["segmento"])
    p = _plan(c.frame)
    assert "Exchange SinglePartition" not in p
    assert "hashpartitioning(_pid" in p


def test_metrics_never_collect_through_one_partition(spark):
    rk = R.rank_by_score(fx.scored_frame(spark, SF_SMALL), group=["segmento"])
    for df in (R.band_lift(rk), R.capacity_table(rk), R.confusion_at_top(rk), R.qcut_bins(rk)):
        assert "Exchange SinglePartition" not in _plan(df)
