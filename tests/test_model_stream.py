"""Model chain on the fixture training table: train → registry → batch vs stream scoring → hot swap."""
import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from leadlens import config
from leadlens.operators import model as M
from leadlens.operators import prepare as P
from leadlens.operators import registry as RG
from leadlens.plans.cat_training import dag
from leadlens.plans.training_run import train_segments
from leadlens.streaming.scoring import LiveModels, score_stream

from conftest import SF_MID

TINY = M.TrainBudget(n_iter=1, n_folds=2, search_rounds=2, max_rounds=5, n_seeds=1, seed=7)


@pytest.fixture(scope="module")
def run(spark):
    root = tempfile.mkdtemp(prefix="models-", dir="/tmp")
    table = dag(spark, SF_MID).table
    res = train_segments(spark, table, f"{root}/bundles", f"{root}/registry", TINY, now=dt.datetime(2024, 1, 31))
    return root, table, res


def test_registry_has_one_candidate_per_segment(spark, run):
    _, _, res = run
    reg = RG.read_registry(spark, res.registry_path)
    cands = {r["segment"]: r for r in reg.filter(F.col("stage") == "candidate").collect()}
    assert set(cands) == set(config.SEGMENTS)
    for seg, b in res.candidates.items():
        assert b.meta["n_estimators"] >= config.MIN_ROUNDS
        assert set(b.meta["grade_thresholds"]) == {"A", "B"}
        assert b.meta["grade_thresholds"]["A"] >= b.meta["grade_thresholds"]["B"]
        assert b.spec.features == [f for f in config.FEATURE_OVERRIDES[seg] if f in P.load_training_frame(run[1]).columns]
    dec = {r["segment"]: r for r in res.decisions.collect()}
    assert set(dec) == set(config.SEGMENTS)


def test_bundle_roundtrip_scores_identically(spark, run):
    _, table, res = run
    b = res.candidates["main"]
    loaded = M.ModelBundle.load(spark, [r for r in RG.read_registry(spark, res.registry_path).collect()
                                        if r["segment"] == "main" and r["stage"] == "candidate"][0]["path"])
    df = P.segment_frame(P.load_training_frame(table), "main")
    a = {r["ld_mcs_id"]: r["score"] for r in b.score(df, ["ld_mcs_id"]).collect()}
    c = {r["ld_mcs_id"]: r["score"] for r in loaded.score(df, ["ld_mcs_id"]).collect()}
    assert a == c


def test_stream_equals_batch_and_hot_swap(spark, run):
    root, table, res = run
    reg_path = f"{root}/stream_registry"
    reg = RG.read_registry(spark, res.registry_path)
    reg.write.mode("overwrite").parquet(reg_path)
    RG.append_registry(spark, RG.manual_promote(reg, dt.datetime(2024, 1, 31, 12)), reg_path)
    payload = P.load_training_frame(table).drop(config.TARGET, config.SEGMENT_COL, "page_path", "utm_campaign")
    payload.write.mode("overwrite").parquet(f"{root}/src/part=1")
    live = LiveModels(spark, reg_path, reload_interval_s=1e-6)
    out = score_stream(spark, f"{root}/src", payload.schema, f"{root}/sink", f"{root}/ckpt", live, ["ld_mcs_id"])
    bundles, _ = RG.load_live_models(spark, RG.read_registry(spark, reg_path))
    batch = M.score_batch(payload, bundles, ["ld_mcs_id"])
    key = lambda r: (r["ld_mcs_id"], round(r["score"], 12), r["grade"], r["segmento"])
    assert sorted(map(key, out.collect())) == sorted(map(key, batch.collect()))
    v1 = {r[0] for r in out.select("model_version").distinct().collect()}
    RG.append_registry(spark, RG.manual_promote(RG.read_registry(spark, reg_path), dt.datetime(2024, 2, 1), "-v2"), reg_path)
    payload.write.mode("overwrite").parquet(f"{root}/src/part=2")
    out2 = score_stream(spark, f"{root}/src", payload.schema, f"{root}/sink", f"{root}/ckpt", live, ["ld_mcs_id"])
    later = {r[0] for r in out2.filter(F.col("batch_id") > 0).select("model_version").distinct().collect()}
    assert later and all(v.endswith("-v2") for v in later) and not (later & v1)
    assert out2.filter(F.col("batch_id") == 0).count() == payload.count()


def test_replayed_batch_keeps_its_models(spark, run):
    root, table, res = run
    reg_path = f"{root}/replay_registry"
    reg = RG.read_registry(spark, res.registry_path)
    reg.unionByName(RG.manual_promote(reg, dt.datetime(2024, 1, 31, 12))).write.parquet(reg_path)
    live = LiveModels(spark, reg_path, reload_interval_s=1e-6)
    _, first = live.for_batch(f"{root}/replay/_versions/batch_id=0.json")
    RG.append_registry(spark, RG.manual_promote(RG.read_registry(spark, reg_path), dt.datetime(2024, 2, 1), "-v2"), reg_path)
    later = LiveModels(spark, reg_path, reload_interval_s=1e-6)  # as after a restart
    _, replay = later.for_batch(f"{root}/replay/_versions/batch_id=0.json")
    _, second = later.for_batch(f"{root}/replay/_versions/batch_id=1.json")
    assert replay == first and all(v.endswith("-v2") for v in second.values())


def test_interval_of_zero_never_reloads(spark, run):
    _, _, res = run
    off = LiveModels(spark, res.registry_path, reload_interval_s=0)
    assert off.maybe_reload() == [] and off.maybe_reload() == []


def test_second_run_appends_only_its_own_live_rows(spark, run):
    from leadlens.operators.registry import live_metric, promote
    when = lambda d: dt.datetime(2024, 1, d)
    rows = [("main", "candidate", "c1", "p1", "lift_A", 1.2, when(1), "{}"), ("main", "live", "c1", "p1", "lift_A", 1.2, when(2), "{}"),
            ("main", "candidate", "c2", "p2", "lift_A", 1.3, when(3), "{}"), ("landing", "live", "x", "p", "other", 9.0, when(2), "{}")]
    reg = spark.createDataFrame(rows, RG.REGISTRY_SCHEMA)
    decisions = spark.createDataFrame([("main", True)], "segment string, promoted boolean")
    new = promote(reg, decisions, when(2)).collect()  # the same clock as the old row
    assert [(r.segment, r.stage, r.version) for r in new] == [("main", "live", "c2")]
    assert {r.segment: r.metric_value for r in live_metric(reg).collect()} == {"main": 1.2, "landing": None}


def test_evaluation_does_not_depend_on_partitions(spark):
    rows = [(f"L{i}", int(i % 7 == 0), float(i % 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "ld_mcs_id string, y int, score double")
    a, b = M.evaluate_scores(df.repartition(1)), M.evaluate_scores(df.repartition(11))
    assert a == b


def test_failing_live_segment_does_not_stop_others(spark, run):
    _, _, res = run
    reg = RG.read_registry(spark, res.registry_path)
    good = RG.manual_promote(reg, dt.datetime(2024, 3, 1)).filter(F.col("segment") == "main")
    bad = RG.manual_promote(reg, dt.datetime(2024, 3, 1)).filter(F.col("segment") == "landing") \
        .withColumn("path", F.lit("/nonexistent/bundle"))
    bundles, versions = RG.load_live_models(spark, reg.unionByName(good).unionByName(bad))
    assert set(bundles) == {"main"} and set(versions) == {"main"}
    # scoring still covers every routed lead: landing falls back to the loaded model
    payload = P.load_training_frame(run[1])
    scored = M.score_batch(payload, bundles, ["ld_mcs_id"])
    assert scored.count() == payload.count()
    assert {r[0] for r in scored.select("model_segment").distinct().collect()} == {"main"}


def test_damaged_bundle_leaves_the_others(spark, run, tmp_path):
    import shutil
    _, _, res = run
    reg = RG.manual_promote(RG.read_registry(spark, res.registry_path), dt.datetime(2024, 4, 1)).collect()
    moved = []
    for r in reg:
        path = str(tmp_path / r["segment"])
        shutil.copytree(r["path"], path)
        moved.append((*r[:3], path, *r[4:]))
    live = spark.createDataFrame(moved, RG.REGISTRY_SCHEMA)
    assert set(RG.load_live_models(spark, live)[0]) == set(config.SEGMENTS)
    meta = tmp_path / "main" / "meta"
    text = spark.read.text(str(meta)).collect()[0][0].replace('"early": false', '"early": true')
    spark.createDataFrame([(text,)], "v string").coalesce(1).write.mode("overwrite").text(str(meta))
    bundles, versions = RG.load_live_models(spark, live)
    assert set(bundles) == set(versions) == {"landing"}


def test_stream_that_dies_between_write_and_commit(spark, run, monkeypatch):
    from leadlens.streaming import scoring as S
    root, table, res = run
    reg_path = f"{root}/crash_registry"
    RG.append_registry(spark, RG.read_registry(spark, res.registry_path).unionByName(
        RG.manual_promote(RG.read_registry(spark, res.registry_path), dt.datetime(2024, 1, 31, 12))), reg_path)
    payload = P.load_training_frame(table).drop(config.TARGET, config.SEGMENT_COL, "page_path", "utm_campaign")
    payload.write.parquet(f"{root}/crash_src/part=1")
    args = (spark, f"{root}/crash_src", payload.schema, f"{root}/crash_sink", f"{root}/crash_ckpt")

    def die(*_):
        raise RuntimeError("killed")
    monkeypatch.setattr(S, "commit_batch", die)
    with pytest.raises(Exception):
        score_stream(*args, LiveModels(spark, reg_path), ["ld_mcs_id"])
    with pytest.raises(FileNotFoundError):
        S.read_sink(spark, f"{root}/crash_sink")  # the rows are written, but no batch is committed
    monkeypatch.undo()
    out = score_stream(*args, LiveModels(spark, reg_path), ["ld_mcs_id"])
    bundles, _ = RG.load_live_models(spark, RG.read_registry(spark, reg_path))
    key = lambda r: (r["ld_mcs_id"], r["score"], r["grade"])
    assert sorted(map(key, out.collect())) == sorted(map(key, M.score_batch(payload, bundles, ["ld_mcs_id"]).collect()))


def test_seed_summary_against_sql(spark):
    import duckdb
    import pandas as pd
    values = [(s, m, (s * 7 + len(m)) % 5 / 3) for s in range(5) for m in ("pr_auc", "roc", "lift_A")]
    iters = [3, 9, 4, 12, 5, 8]
    got = M.seed_summary(spark, values, iters)
    df, it = pd.DataFrame(values, columns=["seed", "metric", "value"]), pd.DataFrame({"n": iters})  # noqa: F841
    sql = duckdb.sql("SELECT metric, avg(value), stddev_pop(value) FROM df GROUP BY metric").fetchall()
    for metric, mean, std in sql:
        assert got[metric] == {"mean": pytest.approx(mean), "std": pytest.approx(std)}
    assert got["median_best_iter"] == duckdb.sql("SELECT CAST(trunc(median(n)) AS INTEGER) FROM it").fetchall()[0][0] == 6


def test_rows_to_score_are_those_of_the_run(spark, monkeypatch):
    """The training table of a run is built once; the rows that the stream scores are read from it."""
    from leadlens.plans import cat_model as C, cat_streaming as CS
    real, built = C.loaded_table, []
    monkeypatch.setattr(C, "loaded_table", lambda *a: built.append(a) or real(*a))
    monkeypatch.setattr(C, "train_segments", lambda *a, **k: "run")
    monkeypatch.setattr(C, "_RUNS", {})
    sf = "/root/testdata/sf0.001"
    assert C.trained(spark, sf) == C.trained(spark, sf) == "run"
    got = sorted(map(str, CS._payloads(spark, sf).collect()))
    assert len(built) == 1
    assert got and got == sorted(map(str, C.loaded(spark, sf).select(*CS.PAYLOAD_COLS).collect()))
