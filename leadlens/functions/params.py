"""Typed lookup in a repeated key/value array (the analytics ``event_params`` shape).

``array<struct<key string, value struct<string_value string, int_value bigint>>>``:
one typed value per key, NULL when the key is absent or the typed slot is empty.
A key that appears more than once is an error, as it is in the warehouse (a scalar subquery that
returns several rows); only with ``strict=False`` the first occurrence wins.

The key array is projected out of the structs (``arr.key``), the first match is found with
``array_position`` and read with ``get`` (NULL when absent), so the lookup stays inside
whole-stage code generation. Only where some key is there twice are the matches of this key counted.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def param_value(arr: Column | str, key: str, slot: str, strict: bool = True) -> Column:
    arr = F.col(arr) if isinstance(arr, str) else arr
    keys = arr.getField("key")
    pos = F.array_position(keys, F.lit(key))  # 1-based; 0 when absent
    value = F.get(arr, pos - F.lit(1))["value"][slot]  # get(…, -1) is NULL
    if not strict:
        return value
    repeated = (F.size(F.array_distinct(keys)) < F.size(keys)) & (F.size(F.filter(keys, lambda k: k == F.lit(key))) > 1)
    return F.when(repeated, F.raise_error(F.lit(f"more than one value for parameter '{key}'"))).otherwise(value)


def extract_params(arr: Column | str, keys: list[tuple[str, str, str]], strict: bool = True) -> list[Column]:
    """One aliased column per ``(output, key, slot)``."""
    return [param_value(arr, key, slot, strict).alias(out) for out, key, slot in keys]
