"""End-to-end segment training: one Spark session instead of containerised steps.

ingest (load + fingerprint) → per segment (segments train concurrently): features → search →
stability → production fit → in-sample grade cutoffs → candidate bundle → registry rows →
gate vs live → promote.
"""
from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import config
from ..operators import model as M
from ..operators import prepare as P
from ..operators import registry as RG
from ..session import durable


@dataclass
class RunResult:
    registry_path: str
    models_root: str
    decisions: DataFrame
    candidates: dict
    reports: dict


def train_segments(spark: SparkSession, table: DataFrame, models_root: str, registry_path: str,
                   budget: M.TrainBudget, segments=config.SEGMENTS, now: dt.datetime | None = None,
                   table_ref: str = "model_train", data_version: str = "",
                   daily_volume: float = config.DAILY_VOLUME, parallel_segments: int = 2) -> RunResult:
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    df = P.load_training_frame(table).persist()
    prov = RG.provenance_record(df, table_ref, data_version).collect()[0].asDict()
    stats = {r[config.SEGMENT_COL]: r.asDict() for r in P.segment_stats(df, daily_volume).collect()}
    def one_segment(seg: str):
        seg_df = P.segment_frame(df, seg).persist()
        try:
            if seg_df.count() == 0:
                return None
            spec = M.feature_spec(seg_df, config.FEATURE_OVERRIDES.get(seg))
            tuned = M.tune_segment(seg_df, spec, budget)
            stab = M.holdout_stability(seg_df, spec, tuned.params, budget)
            bundle = M.fit_production(seg_df, seg, spec, tuned.params, stab["median_best_iter"])
            seg_daily = float(stats.get(seg, {}).get("seg_daily") or 0.0)
            report = M.evaluation_report(tuned.test_scores, seg, seg_daily)
            block = report["test_block"].collect()[0]
            bundle.meta.update({"grade_thresholds": M.in_sample_thresholds(bundle, seg_df), "metrics": stab,
                                "test_metrics": {**tuned.test_metrics, "test_precision_top10": float(block["precision"]),
                                                 "test_recall_top10": float(block["recall"]),
                                                 "seg_daily_volume": seg_daily},
                                "provenance": prov})
            version = f"{now:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"
            path = f"{models_root}/candidate/{seg}/{version}"
            bundle.save(path)
            metric = config.PROMOTION["metric"]
            value = stab.get(metric, {}).get("mean", float("nan"))
            row = (seg, "candidate", version, path, metric, float(value), now, M.bundle_meta_json(bundle.meta))
            return row, bundle, report
        finally:
            seg_df.unpersist()

    # segments are independent branches: their Spark jobs run concurrently from threads
    with ThreadPoolExecutor(max_workers=max(1, min(len(segments), parallel_segments))) as pool:
        results = list(pool.map(one_segment, segments))
    cand_rows, candidates, reports = [], {}, {}
    for seg, res in zip(segments, results):
        if res is not None:
            cand_rows.append(res[0])
            candidates[seg], reports[seg] = res[1], res[2]
    cand_df = spark.createDataFrame(cand_rows, RG.REGISTRY_SCHEMA)
    RG.append_registry(spark, cand_df, registry_path)
    registry = RG.read_registry(spark, registry_path)
    judged_against = RG.live_versions(registry)
    decisions = durable(RG.promotion_gate(cand_df.select("segment", "metric_value"), RG.live_metric(registry)))
    RG.promote_if_unchanged(spark, registry_path, decisions, judged_against, now + dt.timedelta(seconds=1))
    df.unpersist()
    return RunResult(registry_path, models_root, decisions, candidates, reports)

