"""Date-sharded analytics events.

Shards are stored as one parquet dataset partitioned by ``suffix`` (``YYYYMMDD`` for daily
shards, ``intraday_YYYYMMDD`` for partial ones). The shard filter is written on the
partition column with literal bounds, so it becomes partition pruning at the scan.

Beside the shards a small table ``_stats`` keeps the earliest and latest event time of each shard, as of the
state of its folder (files, bytes, time of the last change). ``event_bounds`` reads these rows instead of the
events, and the events of shards that have no row for their present state only.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..functions.timeparts import add_months_py
from ..session import hadoop_fs

_KV = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StructType([
        T.StructField("string_value", T.StringType()),
        T.StructField("int_value", T.LongType()),
    ])),
])

EVENT_SCHEMA = T.StructType([
    T.StructField("event_name", T.StringType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("event_params", T.ArrayType(_KV)),
    T.StructField("user_properties", T.ArrayType(_KV)),
    T.StructField("geo", T.StructType([
        T.StructField("country", T.StringType()),
        T.StructField("region", T.StringType()),
    ])),
    # partition column: taken as text from this schema, never inferred as an integer
    T.StructField("suffix", T.StringType()),
])


def read_event_shards(spark: SparkSession, path: str) -> DataFrame:
    """All shards of the event dataset at ``path`` (partitioned by ``suffix``)."""
    return spark.read.schema(EVENT_SCHEMA).option("basePath", path).parquet(path)


def write_event_shards(events: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write shards (``append`` adds to those at ``path``) and the statistics of the new ones."""
    events.write.mode(mode).partitionBy("suffix").parquet(path)
    refresh_shard_stats(events.sparkSession, path)


STATS = "_stats"
STATS_SCHEMA = "suffix string, n_files long, n_bytes long, changed long, min_timestamp long, max_timestamp long, n_rows long"
_STATE = ["suffix", "n_files", "n_bytes", "changed"]


def shard_states(spark: SparkSession, path: str) -> dict[str, tuple[int, int, int]]:
    """Files, bytes and time of the last change of each shard's folder (metadata calls; one row a shard)."""
    fs, root = hadoop_fs(spark, path)
    out = {}
    for st in fs.listStatus(root) if fs.exists(root) else []:
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("suffix="):
            total = fs.getContentSummary(st.getPath())
            out[name.split("=", 1)[1]] = (total.getFileCount(), total.getLength(), st.getModificationTime())
    return out


def _known_stats(spark: SparkSession, path: str, states: dict[str, tuple[int, int, int]]) -> DataFrame:
    """The statistics that hold for the present state of their shard, one row a shard."""
    fs, p = hadoop_fs(spark, f"{path}/{STATS}")
    rows = spark.read.schema(STATS_SCHEMA).parquet(f"{path}/{STATS}") if fs.exists(p) else spark.createDataFrame([], STATS_SCHEMA)
    now = spark.createDataFrame([(k, *v) for k, v in states.items()], "suffix string, n_files long, n_bytes long, changed long")
    return rows.join(F.broadcast(now), _STATE).dropDuplicates(["suffix"])  # one row a shard on the broadcast side


def _stats_of(shards: DataFrame) -> DataFrame:
    ts = F.col("event_timestamp")
    return shards.groupBy("suffix").agg(F.min(ts).alias("min_timestamp"), F.max(ts).alias("max_timestamp"),
                                        F.count(F.lit(1)).alias("n_rows"))


def refresh_shard_stats(spark: SparkSession, path: str) -> list[str]:
    """Read the shards that have no statistics for their present state and add these; the shards read. A state is taken
    before its shard is read, so one that changes meanwhile is read again the next time."""
    states = shard_states(spark, path)
    known = {r["suffix"] for r in _known_stats(spark, path, states).select("suffix").collect()}
    missing = sorted(set(states) - known)
    if missing:
        now = spark.createDataFrame([(k, *states[k]) for k in missing], "suffix string, n_files long, n_bytes long, changed long")
        new = _stats_of(read_event_shards(spark, path).filter(F.col("suffix").isin(missing)))
        (now.join(new, "suffix").select("suffix", "n_files", "n_bytes", "changed", "min_timestamp", "max_timestamp", "n_rows")
         .coalesce(1).write.mode("append").parquet(f"{path}/{STATS}"))
    return missing


def event_bounds(spark: SparkSession, path: str, execution_date: dt.date, lookback_months: int = config.LOOKBACK_MONTHS,
                 upper_bound: bool = False) -> DataFrame:
    """(min_timestamp, max_timestamp) of the shards that ``base_events`` keeps, from their statistics; null without events."""
    window = lambda df: base_events(df, execution_date, lookback_months, upper_bound)
    states = shard_states(spark, path)
    stats = _known_stats(spark, path, states)
    known = {r["suffix"] for r in stats.select("suffix").collect()}
    parts = stats.select("suffix", "min_timestamp", "max_timestamp")
    missing = sorted(set(states) - known)
    if missing:
        rest = read_event_shards(spark, path).filter(F.col("suffix").isin(missing))
        parts = parts.unionByName(_stats_of(rest).drop("n_rows"))
    return window(parts).agg(F.min("min_timestamp").alias("min_timestamp"), F.max("max_timestamp").alias("max_timestamp"))


def shard_lower_bound(execution_date: dt.date, lookback_months: int = config.LOOKBACK_MONTHS) -> str:
    return add_months_py(execution_date, -lookback_months).strftime("%Y%m%d")


def base_events(shards: DataFrame, execution_date: dt.date,
                lookback_months: int = config.LOOKBACK_MONTHS, upper_bound: bool = False) -> DataFrame:
    """Daily shards (suffix of exactly eight digits) from ``execution_date − lookback``.

    No upper bound by default: a back-dated run still reads later shards. ``upper_bound``
    adds ``suffix <= execution_date`` for reproducible back-fills.
    """
    sfx = F.col("suffix")
    cond = sfx.rlike(config.SHARD_SUFFIX_PATTERN) & (sfx >= F.lit(shard_lower_bound(execution_date, lookback_months)))
    if upper_bound:
        cond = cond & (sfx <= F.lit(execution_date.strftime("%Y%m%d")))
    return shards.filter(cond)
