"""Every oracle-backed registered query equals its DuckDB twin at sf0.001."""
import pytest

import os, sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import __spark_entry__ as E  # noqa: E402
from oracle_check import duck, frame_digest

from conftest import SF_SMALL

SLOW = {"sink_training_table", "sink_stage_parquet"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(k for k in E.oracle_sql() if k not in SLOW))
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[key])
    srows, drows = [tuple(r) for r in sdf.collect()], rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert frame_digest(srows, sdf.columns)[0] == frame_digest(drows, rel.columns)[0]


def test_every_query_has_a_callable():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 80


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "ld_mcs_id" in df.columns
