"""Splits on leads with both labels, without an id, and repeated rows."""
from collections import Counter

import pytest

from leadlens.operators.registry import data_fingerprint
from leadlens.operators.split import stratified_folds, stratified_split


@pytest.fixture(scope="module")
def leads(spark):
    rows = [(f"L{i}", d, int(i % 6 == 0 and d == 1), f"v{i}") for i in range(90) for d in range(2)]  # one row per lead and day
    rows += [(None, 0, 1, "a"), (None, 0, 0, "b"), (None, 0, 0, "b"), ("L3", 0, 0, "v3")]  # no id, repeated rows
    return spark.createDataFrame(rows, "ld_mcs_id string, day int, y int, v string").repartition(5)


def test_rows_stay_and_leads_do_not_leak(leads):
    before = Counter(map(tuple, leads.collect()))
    for seed in (0, 1):
        for out, col in ((stratified_split(leads, seed), "split"), (stratified_folds(leads, seed, 4), "fold")):
            rows = out.select("ld_mcs_id", "day", "y", "v", col).collect()
            assert Counter(tuple(r)[:4] for r in rows) == before and all(r[col] is not None for r in rows)
            parts = {}
            for r in rows:
                if r.ld_mcs_id is not None:
                    parts.setdefault(r.ld_mcs_id, set()).add(r[col])
            assert all(len(p) == 1 for p in parts.values())


def test_a_lead_counts_once_by_its_largest_label(leads):
    out = stratified_split(leads.filter("ld_mcs_id IS NOT NULL"), 0).select("ld_mcs_id", "split").distinct().collect()
    positive = {f"L{i}" for i in range(90) if i % 6 == 0}
    assert Counter(r.split for r in out if r.ld_mcs_id in positive) == {"train": 10, "eval": 1, "test": 4}
    assert sum(r.ld_mcs_id not in positive for r in out) == 75


def test_split_does_not_depend_on_partitions(leads):
    a, b = (Counter(map(tuple, stratified_split(df, 3).collect())) for df in (leads.repartition(1), leads.repartition(9)))
    assert a == b


def test_fingerprint_tells_null_places_apart(spark):
    schema = "ld_mcs_id string, y int"
    h = [data_fingerprint(spark.createDataFrame(rows, schema)).first()["data_hash"]
         for rows in ([("a", None), (None, 1)], [("a", None), ("1", None)], [(None, 1), ("a", None)])]
    assert h[0] == h[2] != h[1]
