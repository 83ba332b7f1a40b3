"""Seeded, stratified, exact-share splits and folds.

The split unit is a key (default: the lead id) with one class, its largest label, so every row
of one lead lands in the same split, also when the lead has both labels; a row without a key is a
unit of its own. Units are ordered inside each class by a seeded SHA-256 of the key and ranked
with the distributed rank (grouped by class, low cardinality), so class shares are exact
and no class is numbered inside one task.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from .rank import per_group, running_totals


def seeded_key(seed: int, key: str) -> F.Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)


def split_sizes(n: int, test: float = config.SPLIT_TEST, eval_of_rest: float = config.SPLIT_EVAL_OF_REST) -> tuple[int, int, int]:
    """(train, eval, test) sizes of one class: held-out ``ceil(test·n)``, of which
    ``ceil(eval_of_rest·held)`` is the test part (the rest is the eval part)."""
    held = math.ceil(test * n)
    te = math.ceil(eval_of_rest * held)
    return n - held, held - te, te


def _units(df: DataFrame, key: str, y: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with its split unit ``_u``, and the units with one class each (the largest label).

    A unit is a key with all its rows; a row without a key is a unit of its own content.
    """
    row = F.concat(F.lit("row:"), F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}), 256))
    rows = df.withColumn("_u", F.coalesce(F.concat(F.lit("key:"), F.col(key).cast("string")), row))
    units = rows.groupBy("_u").agg(F.coalesce(F.max(F.col(y).cast("int")), F.lit(0)).alias("_y"))
    return rows, units.withColumn("_k", F.regexp_replace("_u", "^key:", ""))


def _ranked_units(units: DataFrame, seed: int):
    return running_totals(units.withColumn("_h", seeded_key(seed, "_k")), [F.col("_h").asc(), F.col("_u").asc()], ["_y"],
                          rank_col="_r")


def stratified_split(df: DataFrame, seed: int, key: str = "ld_mcs_id", y: str = config.TARGET) -> DataFrame:
    """Add ``split`` ∈ {train, eval, test} with per-class exact 70/10/20 shares of units; every row stays, once."""
    rows, units = _units(df, key, y)
    rk = _ranked_units(units, seed)
    sizes = {g: split_sizes(n) for g, n in rk.counts.items()}
    tr = per_group({g: s[0] for g, s in sizes.items()}, ["_y"], "long")
    ev = per_group({g: s[0] + s[1] for g, s in sizes.items()}, ["_y"], "long")
    split = F.when(F.col("_r") <= tr, "train").when(F.col("_r") <= ev, "eval").otherwise("test")
    return rows.join(rk.frame.select("_u", split.alias("split")), "_u", "left").drop("_u")


def stratified_folds(df: DataFrame, seed: int, n_folds: int = config.N_FOLDS, key: str = "ld_mcs_id",
                     y: str = config.TARGET) -> DataFrame:
    """Add ``fold`` ∈ [0, n_folds): per class, units in seeded order dealt round-robin; every row stays, once."""
    rows, units = _units(df, key, y)
    rk = _ranked_units(units, seed + 1_000_003)
    assigned = rk.frame.select("_u", ((F.col("_r") - 1) % n_folds).cast("int").alias("fold"))
    return rows.join(assigned, "_u", "left").drop("_u")
