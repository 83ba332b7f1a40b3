"""Registered queries: stream scoring and model hot swap: rows-only checks, and the versions by SQL.

Lead payloads are the prepared training-table rows written as parquet files into a source
folder; the stream scores them with the live models of the registry of a trained run.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import config
from ..operators import registry as RG
from ..session import scratch_path
from ..streaming.scoring import LiveModels, score_stream
from .cat_model import operator_registry, run_rows, trained
from .catalogue import register
from . import oracle as O
from ..functions.text import route_segment
from ..sources import fixtures as fx

PAYLOAD_COLS = ["ld_mcs_id", "user_pseudo_id", "product_id", "page_name", "page_location", "platform", "form_name",
                "market_site", "language_site", "ga_session_id", "ga_session_number", "user_country",
                "user_province", "user_studies"]


def _stream_registry(spark, res, root: str) -> str:
    """Copy of the run's registry in which an operator has made the newest candidates live."""
    reg_path = f"{root}/registry"
    operator_registry(spark, res).write.mode("overwrite").parquet(reg_path)
    return reg_path


def _payloads(spark, sf_dir):
    return run_rows(spark, sf_dir).select(*PAYLOAD_COLS)


@register("score_stream")
def q_score_stream(spark, sf_dir):
    """Stream the lead payloads through the same derive → encode → model path as batch scoring."""
    res = trained(spark, sf_dir)
    root = scratch_path(spark, "stream")
    reg_path = _stream_registry(spark, res, root)
    payload = _payloads(spark, sf_dir)
    payload.repartition(2).write.mode("overwrite").parquet(f"{root}/source")
    live = LiveModels(spark, reg_path, reload_interval_s=1e-6)
    out = score_stream(spark, f"{root}/source", payload.schema, f"{root}/sink", f"{root}/checkpoint", live,
                       ["ld_mcs_id"], max_files_per_trigger=1)
    return out.select("ld_mcs_id", config.SEGMENT_COL, "score", "grade", "model_segment", "model_version")


@register("model_hot_swap")
def q_model_hot_swap(spark, sf_dir):
    """A live-version bump between two arrivals: later batches are scored by the new version."""
    res = trained(spark, sf_dir)
    root = scratch_path(spark, "hotswap")
    reg_path = _stream_registry(spark, res, root)
    payload = _payloads(spark, sf_dir)
    live = LiveModels(spark, reg_path, reload_interval_s=1e-6)
    payload.write.mode("overwrite").parquet(f"{root}/source/part=1")
    src = f"{root}/source"
    schema = payload.schema
    score_stream(spark, src, schema, f"{root}/sink", f"{root}/checkpoint", live, ["ld_mcs_id"])
    # operator re-promotes each segment's newest candidate under a new live version
    bump = RG.manual_promote(RG.read_registry(spark, reg_path), dt.datetime(2024, 2, 1), "-v2")
    RG.append_registry(spark, bump, reg_path)
    payload.write.mode("overwrite").parquet(f"{root}/source/part=2")
    out = score_stream(spark, src, schema, f"{root}/sink", f"{root}/checkpoint", live, ["ld_mcs_id"])
    return (out.groupBy("batch_id", "model_segment", "model_version")
            .agg(F.count(F.lit(1)).alias("n_scored"), F.avg("score").alias("mean_score")))


VERSIONS_SQL = f"""WITH {O.FX_FLAT},
arrived AS (
  SELECT event_id, CASE WHEN lower(trim(platform)) = 'landing' THEN 'landing' ELSE 'main' END AS segmento, event_timestamp, event_name FROM fx_flat),
history AS (
  SELECT segmento, min(event_timestamp) AS since, 'v' || CAST(event_timestamp // 86400000000 AS VARCHAR) AS version
  FROM arrived WHERE event_name = 'purchase' GROUP BY segmento, event_timestamp // 86400000000)
SELECT a.event_id, a.segmento, h.version AS model_version
FROM arrived a ASOF LEFT JOIN history h ON a.segmento = h.segmento AND a.event_timestamp >= h.since"""


def _arrivals(spark, sf_dir):
    flat = fx.flat_events(spark, sf_dir)
    return flat.select("event_id", route_segment(F.col("platform")).alias(config.SEGMENT_COL),
                       F.timestamp_micros("event_timestamp").alias("arrived_at"), "event_name")


def _daily_versions(spark, sf_dir):
    """A registry in which each segment's first purchase of a day promotes a version named by the day."""
    day = F.expr("unix_micros(arrived_at) div 86400000000")
    first = (_arrivals(spark, sf_dir).filter(F.col("event_name") == "purchase").groupBy(config.SEGMENT_COL, day.alias("day"))
             .agg(F.min("arrived_at").alias("created_at")))
    return first.select(F.col(config.SEGMENT_COL).alias("segment"), F.lit("live").alias("stage"),
                        F.concat(F.lit("v"), F.col("day").cast("string")).alias("version"), F.lit("p").alias("path"),
                        F.lit("lift_A").alias("metric"), F.lit(1.0).alias("metric_value"), "created_at", F.lit("{}").alias("meta"))


@register("model_versions_asof", VERSIONS_SQL)
def q_model_versions_asof(spark, sf_dir):
    """The model version that was live for each event's segment when the event arrived."""
    out = RG.versions_asof(_arrivals(spark, sf_dir), _daily_versions(spark, sf_dir), "arrived_at")
    return out.select("event_id", config.SEGMENT_COL, "model_version")
