"""Sinks: training table, per-segment stage dataset, written intermediate tables.

All paths default to folders under the shared checkpoint folder (``spark.checkpoint.dir``;
only a local session without that setting falls back to a local folder).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..session import scratch_path


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Full rebuild of a parquet table (``overwrite``)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def roundtrip_table(spark: SparkSession, df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Materialise ``df`` and return a frame reading it back (lineage cut by storage)."""
    path = path or scratch_path(spark, name)
    write_table(df, path)
    return spark.read.parquet(path)


def write_stage(df: DataFrame, path: str) -> str:
    """One dataset for all segments, partitioned by segment (replaces per-segment copies)."""
    return write_table(df, path, [config.SEGMENT_COL])


def read_stage(spark: SparkSession, path: str, segment: str | None = None) -> DataFrame:
    df = spark.read.option("basePath", path).parquet(path)
    if segment is not None:
        # filter on the partition column: pruned to one folder at the scan
        df = df.filter(F.col(config.SEGMENT_COL) == F.lit(segment))
    return df
