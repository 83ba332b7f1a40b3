"""CRM lead table and its date-partitioned snapshot history.

History layout: parquet folders ``execution_date=<day>/batch=<id>``, one full lead snapshot a day, and a
commit log whose newest entry names the live folder of each day (the manifest; at most one entry a retained
day). Logical operators (``history_after_append``, ``asof_snapshot``) are DataFrame functions;
``append_snapshot`` is the physical write: it prepares today's folder aside and then puts one manifest, so
that the replaced day, the expired days and the clearing of a day without leads become visible at once.

A history written before there was a manifest (files directly below ``execution_date=<day>``) is read as it
is; the first append takes its days into the manifest.
"""
from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions.timeparts import add_months_py
from ..session import hadoop_fs
from .commits import CommitLog

LEAD_SCHEMA = T.StructType([
    T.StructField("ld_mcs_id", T.StringType()),
    T.StructField("ld_createdon", T.TimestampType()),
    T.StructField(config.RAW_TARGET, T.IntegerType()),
])

HISTORY_SCHEMA = T.StructType([
    T.StructField("execution_timestamp", T.TimestampType()),
    T.StructField("ld_mcs_id", T.StringType()),
    T.StructField("ld_createdon", T.TimestampType()),
    T.StructField(config.RAW_TARGET, T.IntegerType()),
    T.StructField("execution_date", T.DateType()),
])

SNAPSHOT_COLUMNS = ["execution_date", "execution_timestamp", "ld_mcs_id", "ld_createdon", config.RAW_TARGET]


def read_lead_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEAD_SCHEMA).parquet(path)


def snapshot_frame(leads: DataFrame, today: dt.date, now: dt.datetime) -> DataFrame:
    """Today's full lead snapshot stamped with the (injected) run date and time."""
    return leads.select(
        F.lit(today).cast("date").alias("execution_date"),
        F.lit(now).cast("timestamp").alias("execution_timestamp"),
        F.col("ld_mcs_id"), F.col("ld_createdon"), F.col(config.RAW_TARGET),
    )


def retention_floor(today: dt.date, lookback_months: int = config.LOOKBACK_MONTHS) -> dt.date:
    return add_months_py(today, -lookback_months)


def history_retained(history: DataFrame, today: dt.date,
                     lookback_months: int = config.LOOKBACK_MONTHS) -> DataFrame:
    """Pre-operation of the append: drop today's snapshot (rerun) and expired ones."""
    d = F.col("execution_date")
    return history.filter((d != F.lit(today)) & (d >= F.lit(retention_floor(today, lookback_months))))


def history_after_append(history: DataFrame, leads: DataFrame, today: dt.date, now: dt.datetime,
                         lookback_months: int = config.LOOKBACK_MONTHS) -> DataFrame:
    """The history table as it is after today's idempotent append."""
    kept = history_retained(history, today, lookback_months).select(*SNAPSHOT_COLUMNS)
    return kept.unionByName(snapshot_frame(leads, today, now))


def _files(spark: SparkSession, folder: str) -> list:
    """Data files directly in ``folder``."""
    fs, p = hadoop_fs(spark, folder)
    found = fs.listStatus(p) if fs.exists(p) else []
    return [st for st in found if st.isFile() and not st.getPath().getName().startswith(("_", "."))]


def _plain_days(spark: SparkSession, path: str) -> dict[str, str]:
    """Days of a history without a manifest: day to folder. Batches are not among them, as no manifest names them."""
    fs, root = hadoop_fs(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(root) if st.isDirectory()] if fs.exists(root) else []
    return {n.split("=", 1)[1]: n for n in names if n.startswith("execution_date=") and _files(spark, f"{path}/{n}")}


def append_snapshot(spark: SparkSession, leads: DataFrame, path: str, today: dt.date, now: dt.datetime,
                    lookback_months: int = config.LOOKBACK_MONTHS) -> None:
    """Physical append, idempotent for same-day reruns: today's snapshot replaces today's earlier one (or clears the
    day if there are no leads) and expired days go, all by one manifest. A run that dies before the manifest leaves
    the old state, one that dies after it the new one. Of two runs at a time both count, the later one for its day.

    Folders that a manifest drops stay for readers that have planned on them and are deleted by the append after.
    """
    day, floor = today.isoformat(), retention_floor(today, lookback_months).isoformat()
    folder = f"execution_date={day}/batch={uuid.uuid4().hex}"
    snapshot_frame(leads, today, now).drop("execution_date").write.parquet(f"{path}/{folder}")
    empty = spark.read.schema(LEAD_SCHEMA).parquet(f"{path}/{folder}").limit(1).count() == 0
    old: list[str] = []

    def manifest(last: dict | None) -> dict:
        state = last or {"live": _plain_days(spark, path), "dropped": []}
        live = {d: f for d, f in state["live"].items() if d >= floor and d != day}
        if not empty:
            live[day] = folder
        old[:] = state["dropped"]
        left = [f for f in old if _is_there(spark, path, f)]
        gone = [f for f in state["live"].values() if f not in live.values()] + ([folder] if empty else [])
        return {"live": live, "dropped": left + gone}

    CommitLog(spark, path).replace(manifest)
    for f in old:
        _delete_snapshot(spark, path, f)


def _is_there(spark: SparkSession, path: str, folder: str) -> bool:
    fs, p = hadoop_fs(spark, f"{path}/{folder}")
    return fs.exists(p) if "/batch=" in folder else bool(_files(spark, f"{path}/{folder}"))


def _delete_snapshot(spark: SparkSession, path: str, folder: str) -> None:
    """Delete one dropped folder; of a plain day its files only, as batches of that day may lie beside them."""
    fs, p = hadoop_fs(spark, f"{path}/{folder}")
    if "/batch=" in folder:
        fs.delete(p, True)
        return
    for st in fs.listStatus(p) if fs.exists(p) else []:
        if st.isFile():
            fs.delete(st.getPath(), False)
    if fs.exists(p) and not len(fs.listStatus(p)):
        fs.delete(p, False)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The live snapshots of the history at ``path``; the partition column is ``execution_date``."""
    state = CommitLog(spark, path).last()
    read = spark.read.schema(HISTORY_SCHEMA).option("basePath", path)
    folders = sorted((state["live"] if state else _plain_days(spark, path)).values())
    batched, plain = [f for f in folders if "/batch=" in f], [f for f in folders if "/batch=" not in f]
    parts = [read.parquet(*[f"{path}/{f}" for f in batched]).select(*HISTORY_SCHEMA.names)] if batched else []
    if plain:  # their files alone, not the batches below them
        files = [str(st.getPath()) for f in plain for st in _files(spark, f"{path}/{f}")]
        parts += [read.parquet(*files).select(*HISTORY_SCHEMA.names)] if files else []
    if not parts:
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def asof_date(history: DataFrame, execution_date: dt.date):
    """Scalar subquery: newest snapshot date ≤ ``execution_date``, else the oldest one."""
    d = F.col("execution_date")
    return history.agg(F.coalesce(F.max(F.when(d <= F.lit(execution_date), d)), F.min(d))).scalar()


def asof_snapshot(history: DataFrame, execution_date: dt.date) -> DataFrame:
    """Rows of the chosen snapshot. An empty history gives an empty frame.

    The comparison is on the partition column, so a history read from storage is
    pruned to one partition at run time.
    """
    return history.filter(F.col("execution_date") == asof_date(history, execution_date))
