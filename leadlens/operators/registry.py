"""Data fingerprint, provenance, model registry, promotion gate and live-model lookup.

The registry is an append-only table: rows are written to a folder of their own and become part of it by an entry of its
commit log, so concurrent writers lose nothing and readers see whole commits only. "Live" for a segment is its newest
``stage = 'live'`` row. Promotion appends a live row pointing at the candidate's bundle, if the live version is still the
one that the gate judged against. (Parquet files at the root of the folder, written by other means, count as rows too.)
"""
from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config
from ..session import hadoop_fs
from ..sources.commits import CommitLog

REGISTRY_SCHEMA = ("segment string, stage string, version string, path string, metric string, "
                   "metric_value double, created_at timestamp, meta string")


def row_hash(line: Column) -> Column:
    """First 60 bits of SHA-256 of a text line, as an exact decimal."""
    return F.conv(F.substring(F.sha2(line, 256), 1, 15), 16, 10).cast("decimal(38,0)")


def data_fingerprint(df: DataFrame, key: str = "ld_mcs_id", y: str = config.TARGET) -> DataFrame:
    """``(n_rows, data_hash)``: order-insensitive and multiset-safe content hash of
    ``key|y`` lines — the sum of per-line hashes (partial-aggregated), then SHA-256 of
    ``count:sum``. Changes only when rows or labels change."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~"))  # noqa: E731 — NULL has a mark of its own
    line = F.concat(part(key), F.lit("|"), part(y))
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(row_hash(line)), F.lit(0).cast("decimal(38,0)")).alias("_s"))
    return agg.select("n_rows", F.sha2(F.concat(F.col("n_rows").cast("string"), F.lit(":"), F.col("_s").cast("string")), 256).alias("data_hash"))


def provenance_record(df: DataFrame, table_ref: str, data_version: str, key: str = "ld_mcs_id") -> DataFrame:
    fp = data_fingerprint(df, key)
    return fp.select(F.lit(table_ref).alias("table_ref"), F.lit(data_version).alias("data_version"), "n_rows", "data_hash")


def _fmt(c: Column) -> Column:
    return F.format_string("%.3f", c)


def promotion_gate(candidates: DataFrame, live: DataFrame, metric: str = config.PROMOTION["metric"],
                   min_abs: float = config.PROMOTION["min_abs"],
                   max_regression: float = config.PROMOTION["max_regression"]) -> DataFrame:
    """Soft gate per segment; never raises.

    ``candidates``/``live``: ``(segment, metric_value)``. A candidate must reach ``min_abs``
    (NaN or NULL never does); with no live metric it bootstraps; otherwise it must be ≥
    ``live − max_regression``. Output: decision, reason code + text, candidate, live (−1
    when none).
    """
    c = candidates.select("segment", F.col("metric_value").alias("cand"))
    lv = live.select("segment", F.col("metric_value").alias("live"))
    j = c.join(lv, "segment", "left")
    cand, live_c = F.col("cand"), F.col("live")
    sane = cand.isNotNull() & ~F.isnan(cand) & (cand >= F.lit(min_abs))
    has_live = live_c.isNotNull() & ~F.isnan(live_c)
    ok = cand >= live_c - F.lit(max_regression)
    code = (F.when(~sane, "below_min").when(~has_live, "bootstrap").when(ok, "no_regression").otherwise("regression"))
    new = F.concat(F.lit(f"{metric} "), F.coalesce(_fmt(cand), F.lit("missing")))
    against = F.concat(new, F.lit(" against "), F.coalesce(_fmt(live_c), F.lit("none")), F.lit(f" live, tolerance {max_regression}"))
    text = (F.when(~sane, F.concat(new, F.lit(f" does not reach {min_abs}")))
            .when(~has_live, F.concat(new, F.lit(", first live model of the segment")))
            .when(ok, F.concat(against, F.lit(": within"))).otherwise(F.concat(against, F.lit(": beyond"))))
    promoted = sane & (~has_live | ok)
    return j.select("segment", promoted.alias("promoted"), code.alias("reason_code"), text.alias("reason"),
                    cand.alias("candidate"), F.when(has_live, live_c).otherwise(F.lit(-1.0)).alias("live"))


def latest_per_segment(registry: DataFrame, stage: str) -> DataFrame:
    """Newest row of ``stage`` per segment (registry rows per segment are few)."""
    w = Window.partitionBy("segment").orderBy(F.col("created_at").desc(), F.col("version").desc())
    return (registry.filter(F.col("stage") == F.lit(stage)).withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


def promote(registry: DataFrame, decisions: DataFrame, now: dt.datetime) -> DataFrame:
    """The rows that a promotion appends: a new ``live`` row for every promoted segment, pointing at
    that segment's newest candidate bundle."""
    cand = latest_per_segment(registry, "candidate")
    chosen = cand.join(decisions.filter(F.col("promoted")).select("segment"), "segment", "left_semi")
    return chosen.select("segment", F.lit("live").alias("stage"), "version", "path", "metric", "metric_value",
                         F.lit(now).cast("timestamp").alias("created_at"), "meta")


def live_metric(registry: DataFrame, metric: str = config.PROMOTION["metric"]) -> DataFrame:
    """``(segment, metric_value)`` of the live rows; a row recorded under another metric has none."""
    live = latest_per_segment(registry, "live")
    return live.select("segment", F.when(F.col("metric") == F.lit(metric), F.col("metric_value")).alias("metric_value"))


def _rows_of(spark: SparkSession, path: str, entries: list[dict]) -> DataFrame:
    fs, p = hadoop_fs(spark, path)
    parts = [f"{path.rstrip('/')}/{e['add']}" for e in entries]
    if fs.exists(p) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p)):
        parts.append(path)
    if not parts:
        return spark.createDataFrame([], REGISTRY_SCHEMA)
    return spark.read.schema(REGISTRY_SCHEMA).parquet(*parts)


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """All committed rows."""
    return _rows_of(spark, path, CommitLog(spark, path).entries())


def _write_rows(rows: DataFrame, path: str) -> str:
    """Rows in a folder of their own, not yet part of the registry; its name."""
    name = f"_rows/{uuid.uuid4().hex}"
    rows.select(*[f.split()[0] for f in REGISTRY_SCHEMA.split(", ")]).write.parquet(f"{path.rstrip('/')}/{name}")
    return name


def append_registry(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Append rows in one commit; safe beside other writers."""
    name = _write_rows(rows, path)
    CommitLog(spark, path).commit(lambda entries: {"add": name, "kind": "append"})


def live_versions(registry: DataFrame) -> dict[str, str]:
    return {r["segment"]: r["version"] for r in latest_per_segment(registry, "live").select("segment", "version").collect()}


def promote_if_unchanged(spark: SparkSession, path: str, decisions: DataFrame, judged_against: dict[str, str],
                         now: dt.datetime) -> list[str]:
    """Append the live rows of promoted segments whose live version is still the one in ``judged_against`` (no entry: none
    was live); the promoted segments come back. A run that another promotion has overtaken changes nothing there."""
    wanted = [r["segment"] for r in decisions.filter(F.col("promoted")).select("segment").collect()]
    done: list[str] = []

    def build(entries: list[dict]) -> dict | None:
        registry = _rows_of(spark, path, entries)
        live = live_versions(registry)
        done[:] = [s for s in wanted if live.get(s) == judged_against.get(s)]
        if not done:
            return None
        rows = promote(registry, decisions.filter(F.col("segment").isin(done)), now)
        return {"add": _write_rows(rows, path), "kind": "promote", "segments": done}

    CommitLog(spark, path).commit(build)
    return done


def live_history(registry: DataFrame) -> DataFrame:
    """Which version was live when: (segment, version, valid_from, valid_to), the newest without an end. Of live rows of one
    instant the one that sorts last counts."""
    live = registry.filter(F.col("stage") == "live").groupBy("segment", "created_at").agg(F.max("version").alias("version"))
    w = Window.partitionBy("segment").orderBy("created_at")
    return live.select("segment", "version", F.col("created_at").alias("valid_from"), F.lead("created_at").over(w).alias("valid_to"))


MOST_VERSIONS = 100_000


def versions_asof(rows: DataFrame, registry: DataFrame, time_col: str, segment_col: str = config.SEGMENT_COL) -> DataFrame:
    """``rows`` with the ``model_version`` that was live for their segment when they arrived (NULL: none yet). ``rows`` may
    be a stream: a stream-static join, so a replay gives the same versions whatever has been promoted since. The history
    has one row a promotion; it is broadcast up to ``MOST_VERSIONS`` of them and joined by segment beyond."""
    h = live_history(registry).select(F.col("segment").alias("_seg"), F.col("version").alias("model_version"),
                                      F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"))
    if h.limit(MOST_VERSIONS + 1).count() <= MOST_VERSIONS:
        h = F.broadcast(h)
    at = F.col(time_col)
    return rows.join(h, (F.col(segment_col) == F.col("_seg")) & (at >= F.col("_from")) & (F.col("_to").isNull() | (at < F.col("_to"))),
                     "left").drop("_seg", "_from", "_to")


def registered_hash(meta: str | None) -> str | None:
    """Content hash of a bundle as its registry row states it."""
    return json.loads(meta).get("content_sha256") if meta else None


def load_live_models(spark: SparkSession, registry: DataFrame, segments=config.SEGMENTS) -> tuple[dict, dict]:
    """Live bundle per segment; a segment that fails to load, or whose content is not what was registered, is skipped, not
    fatal.

    Returns ``(bundles, versions)``.
    """
    from .model import ModelBundle
    live = {r["segment"]: r for r in latest_per_segment(registry, "live").collect()}
    bundles, versions = {}, {}
    for seg in segments:
        r = live.get(seg)
        if r is None:
            continue
        try:
            bundles[seg] = ModelBundle.load(spark, r["path"], registered_hash(r["meta"]))
            versions[seg] = r["version"]
        except Exception as e:  # noqa: BLE001 — one bad segment must not take down the others
            print(f"segment {seg}: bundle {r['path']} is unreadable and left out ({e})")
    return bundles, versions


def manual_promote(registry: DataFrame, now: dt.datetime, version_suffix: str = "") -> DataFrame:
    """Operator promotion bypassing the gate: each segment's newest candidate becomes live
    (optionally under a new version id, which is what a hot swap keys on)."""
    cand = latest_per_segment(registry, "candidate")
    return cand.select("segment", F.lit("live").alias("stage"),
                       F.concat(F.col("version"), F.lit(version_suffix)).alias("version"), "path", "metric",
                       "metric_value", F.lit(now).cast("timestamp").alias("created_at"), "meta")
