"""Registry of named queries: ``key -> (spark callable, oracle SQL or None)``.

A query takes ``(spark, sf_dir)`` and returns a DataFrame over that folder's tables.
Queries without oracle SQL (model fitting, streaming) get a rows-only check.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    from . import (cat_features, cat_metrics, cat_model, cat_prepare,  # noqa: F401
                   cat_streaming, cat_training)
