"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import ctypes
import gc
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable, ensure_session, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER_TABLE = {ord(a): b for a, b in zip(UPPER, LOWER, strict=True)}


def by_value(name: str) -> None:
    """Ship the functions of module ``name`` inside the tasks, so that executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


by_value(__name__)


def give_back() -> None:
    """Return what this process has freed to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # a C library that has no such call
        pass


def giving_back(work):
    """``work`` (batches to batches) that returns its memory when its task ends. A worker waits for its next task with
    all that it holds, beside those at work, and an executor's memory is for all of them."""
    def run(batches):
        try:
            yield from work(batches)
        finally:
            give_back()
    return run


#: Whole texts go through Python: what a batch may hold, and the defaults of Spark that give way to it
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
           "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8388608b")}


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, its session set to batches of 1000 rows and 8 MB where it still has Spark's own sizes."""
    conf = docs.sparkSession.conf
    for name, (default, own) in BATCHES.items():
        if conf.get(name, None) == default:
            conf.set(name, own)
    return docs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder."""
    ensure_session(spark)
    return small_batches(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(c, UPPER, LOWER)


def literal_array(values: list) -> Column:
    """Literal array, typed string when empty."""
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def free_names(taken: list[str], n: int) -> list[str]:
    """Column names that are not among ``taken``, in any case."""
    used, out, i = {c.lower() for c in taken}, [], 0
    while len(out) < n:
        if f"_t{i}" not in used:
            out.append(f"_t{i}")
        i += 1
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back: both a lineage cut and a pruned, typed table."""
    spark = df.sparkSession
    ensure_session(spark)
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


__all__ = ["WORD", "LOWER_TABLE", "ascii_lower", "by_value", "durable", "ensure_session", "free_names", "give_back", "giving_back", "literal_array",
           "scratch_path", "small_batches", "stored", "table"]
