"""Commit log, registry commits, compare-and-set promotion, damaged bundles, stream commits after a crash."""
import datetime as dt
import json
import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from leadlens.operators import registry as RG
from leadlens.sources.commits import CommitLog

WHEN = lambda d: dt.datetime(2024, 1, d)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="commits-", dir="/tmp") + "/a b"


def row(segment, stage, version, day=1, value=1.0):
    return (segment, stage, version, f"p/{version}", "lift_A", value, WHEN(day), json.dumps({"v": version}))


def rows(spark, *r):
    return spark.createDataFrame(list(r), RG.REGISTRY_SCHEMA)


def test_entry_is_put_once(spark, folder):
    log = CommitLog(spark, folder)
    assert log.numbers() == [] and log.put(1, {"a": 1}) and not log.put(1, {"a": 2})
    assert log.read(1) == {"a": 1} and not [f for f in os.listdir(f"{folder}/_log") if f.endswith(".tmp")]
    assert log.commit(lambda old: None) is None and log.commit(lambda old: {"n": len(old)}) == {"n": 1}


def test_concurrent_commits_lose_nothing(spark, folder):
    def writer(i):
        for k in range(5):
            CommitLog(spark, folder).commit(lambda old: {"by": i, "k": k, "seen": len(old)})
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(writer, range(6)))
    got = CommitLog(spark, folder).entries()
    assert sorted((e["by"], e["k"]) for e in got) == [(i, k) for i in range(6) for k in range(5)]
    assert [e["seen"] for e in got] == list(range(30))  # each saw all that came before it


def test_concurrent_registry_writers(spark, folder):
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: RG.append_registry(spark, rows(spark, row("main", "candidate", f"v{i}")), folder), range(4)))
    got = RG.read_registry(spark, folder)
    assert sorted(r.version for r in got.collect()) == [f"v{i}" for i in range(4)]
    # rows that no entry names are not part of the registry
    RG._write_rows(rows(spark, row("main", "candidate", "lost")), folder)
    assert RG.read_registry(spark, folder).count() == 4
    assert RG.read_registry(spark, folder + "-none").count() == 0


def test_files_at_the_root_count_as_rows(spark, folder):
    rows(spark, row("main", "live", "old")).write.parquet(folder)
    RG.append_registry(spark, rows(spark, row("main", "live", "new", 2)), folder)
    assert RG.live_versions(RG.read_registry(spark, folder)) == {"main": "new"} and RG.read_registry(spark, folder).count() == 2


def test_overtaken_promotion_changes_nothing(spark, folder):
    RG.append_registry(spark, rows(spark, row("main", "candidate", "c1"), row("main", "live", "l0"), row("landing", "candidate", "d1")), folder)
    yes = spark.createDataFrame([("main", True), ("landing", True), ("other", False)], "segment string, promoted boolean")
    slow = RG.live_versions(RG.read_registry(spark, folder))
    assert slow == {"main": "l0"}
    RG.append_registry(spark, rows(spark, row("main", "live", "l1", 5)), folder)  # a faster run promotes meanwhile
    assert RG.promote_if_unchanged(spark, folder, yes, slow, WHEN(9)) == ["landing"]
    assert RG.live_versions(RG.read_registry(spark, folder)) == {"main": "l1", "landing": "d1"}
    assert RG.promote_if_unchanged(spark, folder, yes, slow, WHEN(9)) == []


def test_one_of_two_racing_promotions_wins(spark, folder):
    RG.append_registry(spark, rows(spark, row("main", "candidate", "c1"), row("main", "live", "l0")), folder)
    yes = spark.createDataFrame([("main", True)], "segment string, promoted boolean")
    judged = RG.live_versions(RG.read_registry(spark, folder))
    with ThreadPoolExecutor(3) as pool:
        won = list(pool.map(lambda d: RG.promote_if_unchanged(spark, folder, yes, judged, WHEN(d)), (3, 4, 5)))
    assert sorted(won) == [[], [], ["main"]]
    assert RG.read_registry(spark, folder).filter(F.col("stage") == "live").count() == 2


def test_versions_as_of_arrival(spark):
    reg = rows(spark, row("main", "live", "v1", 2), row("main", "live", "v2", 5), row("main", "candidate", "x", 3),
               row("landing", "live", "w1", 4), row("main", "live", "v2b", 5))
    came = spark.createDataFrame([("main", WHEN(d)) for d in (1, 2, 4, 5, 9)] + [("landing", WHEN(3)), ("landing", WHEN(4)), (None, WHEN(9))],
                                 "segmento string, at timestamp")
    got = sorted(((r.segmento or "", r.at.day, r.model_version) for r in RG.versions_asof(came, reg, "at").collect()))
    assert got == [("", 9, None), ("landing", 3, None), ("landing", 4, "w1"), ("main", 1, None), ("main", 2, "v1"), ("main", 4, "v1"),
                   ("main", 5, "v2b"), ("main", 9, "v2b")]


def test_replayed_stream_keeps_its_versions(spark, folder):
    """A stream joined with the history, before and after a swap that comes later than its rows."""
    came = spark.createDataFrame([("main", WHEN(d), d) for d in (3, 6)], "segmento string, at timestamp, n int")
    came.write.parquet(f"{folder}/in")
    reg = rows(spark, row("main", "live", "v1", 2), row("main", "live", "v2", 5))
    later = reg.unionByName(rows(spark, row("main", "live", "v3", 8)))
    for name, registry in (("first", reg), ("replay", later)):
        stream = spark.readStream.schema(came.schema).parquet(f"{folder}/in")
        q = (RG.versions_asof(stream, registry, "at").writeStream.format("parquet").option("checkpointLocation", f"{folder}/{name}-ckpt")
             .trigger(availableNow=True).start(f"{folder}/{name}"))
        q.awaitTermination()
        assert sorted((r.n, r.model_version) for r in spark.read.parquet(f"{folder}/{name}").collect()) == [(3, "v1"), (6, "v2")]
