"""Event bounds from shard statistics: no event column in the plan, shards that changed or lack statistics."""
import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from leadlens.operators import training as T
from leadlens.sources import events as EV

EXEC = dt.date(2024, 1, 31)


@pytest.fixture
def path():
    return tempfile.mkdtemp(prefix="stats-", dir="/tmp") + "/events"


def shards(spark, *rows):
    """Rows of (suffix, time)."""
    df = spark.createDataFrame([("view", t, "u", [], [], None, s) for s, t in rows], EV.EVENT_SCHEMA)
    return df


def both(spark, path, **kw):
    got = tuple(EV.event_bounds(spark, path, EXEC, **kw).first())
    scan = T.event_ts_bounds_frame(EV.base_events(EV.read_event_shards(spark, path), EXEC, **kw)).first()
    assert got == tuple(scan)
    return got


def test_bounds_read_no_event(spark, path):
    EV.write_event_shards(shards(spark, ("20240101", 5), ("20240102", 9), ("20240102", 7), ("intraday_20240103", 99), ("20200101", 1)), path)
    df = EV.event_bounds(spark, path, EXEC)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "event_timestamp" not in plan and "_stats" in plan
    assert both(spark, path) == (5, 9)  # neither partial shards nor those before the window count
    assert EV.read_event_shards(spark, path).count() == 5  # the statistics are no shard


def test_new_and_changed_shards(spark, path):
    EV.write_event_shards(shards(spark, ("20240101", 5), ("20240102", 9)), path)
    EV.write_event_shards(shards(spark, ("20240103", 20)), path, "append")
    assert EV.refresh_shard_stats(spark, path) == [] and both(spark, path) == (5, 20)
    shards(spark, ("20240101", 2), ("20240104", 30)).write.mode("append").partitionBy("suffix").parquet(path)
    assert both(spark, path) == (2, 30)  # read from the two shards
    assert EV.refresh_shard_stats(spark, path) == ["20240101", "20240104"]
    assert "event_timestamp" not in EV.event_bounds(spark, path, EXEC)._jdf.queryExecution().executedPlan().toString()
    assert both(spark, path) == (2, 30)


def test_null_times_and_empty_windows(spark, path):
    EV.write_event_shards(shards(spark, ("20240101", None), ("20240102", 4), ("20210101", 1)), path)
    assert both(spark, path) == (4, 4)
    assert both(spark, path, lookback_months=0) == (None, None)
    assert both(spark, path, upper_bound=True) == (4, 4)
    assert tuple(EV.event_bounds(spark, path + "-none", EXEC).first()) == (None, None)


def test_rewritten_dataset(spark, path):
    EV.write_event_shards(shards(spark, ("20240101", 5)), path)
    EV.write_event_shards(shards(spark, ("20240101", 8)), path)
    assert both(spark, path) == (8, 8)


def test_training_table_by_statistics(spark, path):
    from leadlens import config
    from leadlens.sources import fixtures as fx
    from conftest import SF_SMALL
    EV.write_event_shards(fx.event_shards(spark, SF_SMALL), path)
    p = config.RunParams(execution_date=fx.FIXTURE_EXECUTION_DATE, maturity_days=7)
    stored, history = EV.read_event_shards(spark, path), fx.lead_history(spark, SF_SMALL)
    span = EV.event_bounds(spark, path, p.execution_date)
    by_stats = T.build_training_dag(stored, history, p, span).table
    by_scan = T.build_training_dag(stored, history, p).table
    assert sorted(map(tuple, by_stats.collect())) == sorted(map(tuple, by_scan.collect()))
    assert by_stats.filter(F.lit(True)).count() > 0
