"""Registered queries: per-user behavioural features."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..functions.safe import json_int_array_text, json_text_or_null
from ..operators import features as FE
from ..session import ensure_session
from ..sources import fixtures as fx
from . import oracle as O
from .catalogue import register


def _src(spark, sf_dir):
    ensure_session(spark)
    return fx.feature_source(spark, sf_dir)


def _counter(column: str) -> str:
    """A counter or flag read from a person's histogram of event names."""
    name, event, kind = next(x for x in config.BEHAVIOUR_COLUMNS if x[0] == column)
    if kind == "all":
        return f"n_events AS {name}"
    if kind == "per_session":
        return f"n_events / NULLIF(n_sessions, 0) AS {name}"
    seen = f"COALESCE(names['{event}'], 0)"
    return {"count": f"CAST({seen} AS BIGINT)", "int_flag": f"CAST({seen} > 0 AS INTEGER)", "bool_flag": f"({seen} > 0)"}[kind] + f" AS {name}"


def _values(column: str) -> str:
    return f"list_sort(list_distinct(list({column})))"


_COUNTERS = ", ".join(_counter(c) for c in config.BEHAVIOUR_ORDER)
# Two groupings say it all: people (events of a user, as histogram, bounds and value lists) and stays (sessions).
FEATURE_CTES = [O.FX_FLAT, "\nsrc AS (SELECT *, [item_a, item_b] AS item_ids FROM fx_flat)", f"""
people AS (
  SELECT user_pseudo_id, COUNT(*) AS n_events, histogram(event_name) AS names, COUNT(DISTINCT ga_session_id) AS n_sessions,
    MIN(event_timestamp) AS first_visit_ts, {_values('campaign_ids')} AS campaigns, {_values('device_used')} AS devices,
    {_values('page_referrer')} AS referrers,
    list_sort(list_distinct(list_transform(flatten(list(item_ids)), lambda x: TRY_CAST(x AS BIGINT)))) AS products
  FROM src GROUP BY user_pseudo_id
)""", """
stays AS (
  SELECT user_pseudo_id, ga_session_id, (MAX(event_timestamp) - MIN(event_timestamp)) / 1000000 AS seconds
  FROM src WHERE ga_session_id IS NOT NULL GROUP BY user_pseudo_id, ga_session_id
)""", """
visits AS (
  SELECT user_pseudo_id, COUNT(*) AS total_sessions, CAST(ROUND(AVG(seconds), 0) AS BIGINT) AS session_duration_avg,
    MAX(seconds) AS session_duration_max, CAST(ROUND(SUM(seconds), 0) AS BIGINT) AS total_session_time
  FROM stays GROUP BY user_pseudo_id
)"""]


def _json(column: str, out: str) -> str:
    """Values as JSON text; ``null`` for none, and for the events that have no user."""
    return f"CASE WHEN p.user_pseudo_id IS NULL OR len({column}) = 0 THEN 'null' ELSE CAST(to_json({column}) AS VARCHAR) END AS {out}"


def _number(column: str, out: str, none: str = "0") -> str:
    """How many values; ``none`` is the count that is given as NULL (-1: no count is)."""
    return f"CASE WHEN p.user_pseudo_id IS NOT NULL THEN NULLIF(len({column}), {none}) END AS {out}"


def fsql(select: str) -> str:
    return O.with_ctes(*FEATURE_CTES, select=select)


@register("session_duration", fsql("SELECT user_pseudo_id, ga_session_id, ROUND(seconds, 6) AS session_duration_sec FROM stays"))
def q_session_duration(spark, sf_dir):
    """Seconds between first and last event of every non-NULL session."""
    d = FE.session_duration(_src(spark, sf_dir))
    return d.select("user_pseudo_id", "ga_session_id", F.round("session_duration_sec", 6).alias("session_duration_sec"))


@register("user_session_summary", fsql("SELECT * FROM visits"))
def q_user_session_summary(spark, sf_dir):
    """Per user: session count, rounded mean and total duration, longest session."""
    return FE.user_session_summary(_src(spark, sf_dir))


@register("array_unnest_join", fsql("SELECT user_pseudo_id, unnest(item_ids) AS item_id FROM src"))
def q_array_unnest_join(spark, sf_dir):
    """One row per element of each event's item-id array (empty/NULL arrays vanish)."""
    return FE.item_rows(_src(spark, sf_dir))


@register("select_distinct", fsql("SELECT user_pseudo_id, unnest(products) AS product FROM people"))
def q_select_distinct(spark, sf_dir):
    """Distinct (user, safe-cast integer item id) pairs."""
    return FE.distinct_products(_src(spark, sf_dir))


@register("seen_products", fsql("SELECT user_pseudo_id, to_json(products) AS products, len(products) AS num_products FROM people WHERE len(products) > 0"))
def q_seen_products(spark, sf_dir):
    """Sorted distinct castable item ids per user as JSON text, and their count."""
    p = FE.seen_products(_src(spark, sf_dir))
    return p.select("user_pseudo_id", json_int_array_text(F.col("id_seen_products")).alias("products"), "num_products")


def _set_query(col, out, n_out, json_out):
    def q(spark, sf_dir):
        s = FE.value_set(_src(spark, sf_dir), col, out, n_out)
        return s.select("user_pseudo_id", json_text_or_null(F.col(out)).alias(json_out), n_out)
    q.__doc__ = f"Sorted distinct non-NULL `{col}` per user as JSON text (`null` when none) and their count."
    return q


for _key, (_c, _o, _n, _j), _list in zip(["campaign_set", "device_set", "channel_set"], FE.SET_SPECS,
                                           ["campaigns", "devices", "referrers"]):
    register(_key, fsql(f"SELECT user_pseudo_id, CASE WHEN len({_list}) = 0 THEN 'null' ELSE CAST(to_json({_list}) AS VARCHAR) END "
                        f"AS {_j}, len({_list}) AS {_n} FROM people"))(_set_query(_c, _o, _n, _j))


@register("first_visit", fsql("SELECT user_pseudo_id, first_visit_ts FROM people"))
def q_first_visit(spark, sf_dir):
    """Earliest event time per user."""
    return FE.first_visit(_src(spark, sf_dir))


@register("behaviour_counters", fsql(f"SELECT * REPLACE (ROUND(events_per_session, 6) AS events_per_session) FROM "
                                     f"(SELECT user_pseudo_id, {_COUNTERS} FROM people)"))
def q_behaviour_counters(spark, sf_dir):
    """Per user: event count, 22 conditional counts, 9 flags, events per session."""
    b = FE.behaviour_counters(_src(spark, sf_dir))
    return b.withColumn("events_per_session", F.round("events_per_session", 6))


UF_COLUMNS = f"""SELECT p.user_pseudo_id, {_COUNTERS}, v.total_sessions, v.session_duration_avg, v.session_duration_max,
  v.total_session_time, {_json('p.products', 'products')}, {_number('p.products', 'num_products')},
  {_json('p.campaigns', 'campaings')}, {_number('p.campaigns', 'num_campaigns', '-1')},
  {_json('p.devices', 'used_devices')}, {_number('p.devices', 'num_devices', '-1')},
  {_json('p.referrers', 'used_canals')}, {_number('p.referrers', 'num_canals', '-1')},
  CASE WHEN p.user_pseudo_id IS NOT NULL THEN p.first_visit_ts END AS first_visit_ts
FROM people p LEFT JOIN visits v ON v.user_pseudo_id = p.user_pseudo_id"""
_UF_SELECT = f"""SELECT * REPLACE (ROUND(events_per_session, 6) AS events_per_session,
  ROUND(session_duration_max, 6) AS session_duration_max) FROM ({UF_COLUMNS})"""


@register("user_features", fsql(_UF_SELECT))
def q_user_features(spark, sf_dir):
    """All 47 per-user feature columns."""
    uf = FE.user_features(_src(spark, sf_dir))
    return (uf.withColumn("events_per_session", F.round("events_per_session", 6))
              .withColumn("session_duration_max", F.round("session_duration_max", 6)))


@register("feature_left_joins", fsql(
    "SELECT user_pseudo_id, total_events, total_sessions, total_session_time, products, num_products, "
    f"campaings, num_campaigns, first_visit_ts FROM ({UF_COLUMNS})"))
def q_feature_left_joins(spark, sf_dir):
    """The LEFT JOIN side of the feature build: the NULL user keeps its row, matches nothing."""
    uf = FE.user_features(_src(spark, sf_dir))
    return uf.select("user_pseudo_id", "total_events", "total_sessions", "total_session_time", "products",
                     "num_products", "campaings", "num_campaigns", "first_visit_ts")
