"""Snapshot history behind one manifest: failures between the steps, concurrent runs, histories without a manifest."""
import datetime as dt
import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from leadlens.sources import leads as L
from leadlens.sources.commits import CommitLog

D1, D2, LATE = dt.date(2024, 1, 10), dt.date(2024, 1, 11), dt.date(2026, 1, 11)


@pytest.fixture
def path():
    return tempfile.mkdtemp(prefix="manifest-", dir="/tmp") + "/h"


def leads(spark, *ids):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, 1), 1) for i in ids], L.LEAD_SCHEMA)


def append(spark, path, day, *ids, hour=0):
    L.append_snapshot(spark, leads(spark, *ids), path, day, dt.datetime(day.year, day.month, day.day, hour))


def state(spark, path):
    rows = L.read_history(spark, path).select("execution_date", "ld_mcs_id").collect()
    return sorted((r[0], r[1]) for r in rows)


def test_failure_before_the_manifest_leaves_the_old_state(spark, path, monkeypatch):
    append(spark, path, D1, "a", "b")
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "put", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            append(spark, path, LATE, "c")  # would expire D1 and add LATE
        with pytest.raises(OSError):
            append(spark, path, D1)  # would clear D1
    assert state(spark, path) == [(D1, "a"), (D1, "b")]
    append(spark, path, LATE, "c")
    assert state(spark, path) == [(LATE, "c")]


def test_first_run_that_dies_shows_nothing(spark, path, monkeypatch):
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "put", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            append(spark, path, D1, "a")
    assert state(spark, path) == []


def test_failure_after_the_manifest_leaves_the_new_state(spark, path, monkeypatch):
    append(spark, path, D1, "a")
    append(spark, path, D1, "b")
    with monkeypatch.context() as m:
        m.setattr(L, "_delete_snapshot", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            append(spark, path, D2, "c")
    assert state(spark, path) == [(D1, "b"), (D2, "c")]
    append(spark, path, D2, "d")  # deletes what the killed run left
    append(spark, path, D2, "e")
    live = CommitLog(spark, path).last()
    kept = set(live["live"].values()) | set(live["dropped"])
    on_disk = {f"{d}/{b}" for d in os.listdir(path) if d.startswith("execution_date=") for b in os.listdir(f"{path}/{d}")}
    assert on_disk <= kept and len(live["dropped"]) <= 2


def test_a_planned_reader_outlives_one_replacement(spark, path):
    append(spark, path, D1, "a")
    before = L.read_history(spark, path)
    append(spark, path, D1, "b")
    assert [r["ld_mcs_id"] for r in before.collect()] == ["a"] and state(spark, path) == [(D1, "b")]


def test_concurrent_days_are_both_kept(spark, path):
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda d: append(spark, path, dt.date(2024, 1, d), f"x{d}"), (3, 4, 5)))
    assert state(spark, path) == [(dt.date(2024, 1, d), f"x{d}") for d in (3, 4, 5)]


def test_history_without_a_manifest_is_taken_over(spark, path):
    for d, i in ((D1, "a"), (D2, "b")):
        L.snapshot_frame(leads(spark, i), d, dt.datetime(2024, 1, 12)).write.mode("append").partitionBy("execution_date").parquet(path)
    assert state(spark, path) == [(D1, "a"), (D2, "b")]
    append(spark, path, D2, "c")
    assert state(spark, path) == [(D1, "a"), (D2, "c")]
    append(spark, path, dt.date(2024, 1, 12), "d")  # the plain files of D2 go, its batch stays
    assert state(spark, path) == [(D1, "a"), (D2, "c"), (dt.date(2024, 1, 12), "d")]
    assert not [f for f in os.listdir(f"{path}/execution_date={D2}") if f.endswith(".parquet")]


def test_empty_days_and_empty_histories(spark, path):
    append(spark, path, D1)
    assert state(spark, path) == []
    append(spark, path, D1, "a")
    append(spark, path, D1)
    assert state(spark, path) == []
    assert L.read_history(spark, path).columns == L.HISTORY_SCHEMA.names


def test_reader_prunes_days(spark, path):
    for d in range(1, 5):
        append(spark, path, dt.date(2024, 1, d), f"x{d}")
    got = L.read_history(spark, path).filter(F.col("execution_date") == F.lit(dt.date(2024, 1, 2)))
    assert "PartitionFilters: [isnotnull(execution_date" in got._jdf.queryExecution().executedPlan().toString()
    assert [r["ld_mcs_id"] for r in got.collect()] == ["x2"]
