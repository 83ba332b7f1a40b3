"""Correctness under skew: one hot user and the NULL user each hold a third of all rows."""
import duckdb
import numpy as np
import pandas as pd

from leadlens.operators import features as FE
from leadlens.plans.cat_features import FEATURE_CTES, UF_COLUMNS
import os, sys  # noqa: E401
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from oracle_check import frame_digest  # noqa: E402

EVENTS = ["purchase", "page_view", "click", "generate_lead", "book_call", "scroll", "form_success", None]


def _skewed(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    users = np.where(np.arange(n) % 3 == 0, None, np.where(np.arange(n) % 3 == 1, "hot",
                                                           ["u%d" % i for i in rng.integers(0, 40, n)]))
    sess = rng.integers(0, 60, n).astype(object)
    sess[rng.random(n) < 0.1] = None
    return pd.DataFrame({
        "user_pseudo_id": users,
        "ga_session_id": sess,
        "event_timestamp": rng.integers(1_700_000_000_000_000, 1_700_100_000_000_000, n),
        "event_name": [EVENTS[i] for i in rng.integers(0, len(EVENTS), n)],
        "item_ids": [[str(x) for x in rng.integers(0, 30, 2)] + (["bad"] if i % 5 == 0 else []) for i in range(n)],
        "campaign_ids": [None if x < 0.3 else "c%d" % (x * 10 // 1) for x in rng.random(n)],
        "device_used": [None if x < 0.2 else ("mobile" if x < 0.6 else "desktop") for x in rng.random(n)],
        "page_referrer": [None if x < 0.25 else "ref%d" % (x * 100 // 1) for x in rng.random(n)],
    })


def test_user_features_match_sql_under_skew(spark):
    pdf = _skewed()
    schema = ("user_pseudo_id string, ga_session_id bigint, event_timestamp bigint, event_name string, "
              "item_ids array<string>, campaign_ids string, device_used string, page_referrer string")
    src = spark.createDataFrame(pdf, schema).repartition(6)
    got = FE.user_features(src)
    con = duckdb.connect()
    con.register("src_raw", pdf)
    con.sql("CREATE VIEW src AS SELECT user_pseudo_id, CAST(ga_session_id AS BIGINT) AS ga_session_id, "
            "event_timestamp, event_name, item_ids, campaign_ids, device_used, page_referrer FROM src_raw")
    rel = con.sql("WITH " + ",\n".join(FEATURE_CTES[2:]) + "\n" + UF_COLUMNS)
    srows = [tuple(r) for r in got.collect()]
    drows = rel.fetchall()
    assert sorted(got.columns) == sorted(rel.columns)
    assert len(srows) == len(drows) == pdf["user_pseudo_id"].nunique(dropna=False)
    assert frame_digest(srows, got.columns)[0] == frame_digest(drows, rel.columns)[0]
    hot = [r for r in srows if r[0] == "hot"][0]
    assert hot[got.columns.index("total_events")] == 1000


def _skewed_events(path, n=6000, seed=3):
    import datetime as dt
    import json

    import pyarrow as pa
    import pyarrow.parquet as pq
    rng = np.random.default_rng(seed)
    users = np.where(np.arange(n) % 3 == 0, 7, rng.integers(0, 60, n))
    start = dt.datetime(2024, 1, 1)
    ts = [start + dt.timedelta(seconds=int(s)) for s in np.sort(rng.integers(0, 30 * 86400, n))]
    types = np.array(["signup", "purchase", "view", "click", "error"])[rng.integers(0, 5, n)]
    t = pa.table({
        "event_id": pa.array(np.arange(n), pa.int64()),
        "ts": pa.array(ts, pa.timestamp("us")),
        "user_id": pa.array(users, pa.int64()),
        "event_type": pa.array(types),
        "value": pa.array(np.round(rng.random(n) * 100, 2)),
        "props": pa.array([json.dumps({"k": int(k)}) for k in rng.integers(0, 100, n)]),
    })
    pq.write_table(t, f"{path}/events.parquet")


def test_training_dag_matches_sql_with_a_hot_lead(spark, tmp_path):
    from leadlens.plans import oracle as O
    from leadlens.plans.cat_training import dag
    _skewed_events(str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet')")
    d = dag(spark, str(tmp_path))
    for df, cte in ((d.latest_leads, "latest_leads"), (d.valid, "valid_leads"), (d.table, "model_train")):
        rel = con.sql(O.with_dag(f"SELECT * FROM {cte}"))
        srows, drows = [tuple(r) for r in df.collect()], rel.fetchall()
        assert len(srows) == len(drows) and len(srows) > 0
        assert frame_digest(srows, df.columns)[0] == frame_digest(drows, rel.columns)[0]
