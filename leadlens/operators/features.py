"""Per-user behavioural features from an event source.

Input schema: ``user_pseudo_id, ga_session_id, event_timestamp, event_name,
item_ids array<string>, campaign_ids, device_used, page_referrer``.

The reference semantics is seven grouped views LEFT JOINed on the user. Here a user's facts are
aggregated by (user, session) and by (user, set, value) first, partially before the exchange, and
then by user: counters and bounds stay in hash aggregates, a hot user spreads over sessions and
values, and a set is gathered from values that are distinct already, so the memory of a group is the
output itself. The NULL user keeps its behaviour row but matches no joined view, as in a LEFT JOIN
USING(user): its joined columns are NULL (JSON text ``null``).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.safe import json_int_array_text, json_text_or_null, nonempty_or_null

USER = "user_pseudo_id"
SESSION = "ga_session_id"
TS = "event_timestamp"
EVENT = "event_name"


def _counter_aggs() -> list[Column]:
    en = F.col(EVENT)
    aggs = [F.count(F.lit(1)).alias("total_events")]
    aggs += [F.count_if(en == F.lit(ev)).alias(out) for out, ev in config.COUNT_EVENTS]
    aggs += [F.max(F.when(en == F.lit(ev), F.lit(1)).otherwise(F.lit(0))).alias(out) for out, ev in config.INT_FLAGS]
    aggs += [F.max(en == F.lit(ev)).alias(out) for out, ev in config.BOOL_FLAGS]
    return aggs


def behaviour_counters(src: DataFrame) -> DataFrame:
    """``features`` view: per user COUNT(*), 22 conditional counts, 9 flags, events per session."""
    n_sess = F.count_distinct(F.col(SESSION))
    agg = src.groupBy(USER).agg(*_counter_aggs(), n_sess.alias("_n_sessions"))
    return agg.select(USER, *[(_events_per_session() if c == "events_per_session" else F.col(c)).alias(c)
                              for c in config.BEHAVIOUR_ORDER])


def _events_per_session() -> Column:
    return F.try_divide(F.col("total_events"), F.col("_n_sessions").cast("bigint")).cast("double")


def session_duration(src: DataFrame) -> DataFrame:
    """Seconds between first and last event of each non-NULL session."""
    return (src.filter(F.col(SESSION).isNotNull()).groupBy(USER, SESSION)
            .agg(((F.max(TS) - F.min(TS)) / F.lit(1_000_000)).cast("double").alias("session_duration_sec")))


def user_session_summary(src: DataFrame) -> DataFrame:
    """Sessions per user: count, rounded mean and total duration (integers), longest (float)."""
    d = F.col("session_duration_sec")
    return (session_duration(src).groupBy(USER)
            .agg(F.count(F.lit(1)).alias("total_sessions"),
                 F.round(F.avg(d), 0).cast("bigint").alias("session_duration_avg"),
                 F.max(d).alias("session_duration_max"),
                 F.round(F.sum(d), 0).cast("bigint").alias("total_session_time")))


def item_rows(src: DataFrame) -> DataFrame:
    """Lateral unnest of ``item_ids``: one row per element; empty/NULL arrays vanish."""
    return src.select(USER, F.explode("item_ids").alias("item_id"))


def distinct_products(src: DataFrame) -> DataFrame:
    """``SELECT DISTINCT user, SAFE_CAST(item AS INT64)`` keeping castable items."""
    p = F.col("item_id").try_cast("bigint")
    return item_rows(src).select(USER, p.alias("product")).filter(F.col("product").isNotNull()).distinct()


def seen_products(src: DataFrame) -> DataFrame:
    """Sorted distinct castable item ids per user and their count (users with none: no row)."""
    agg = distinct_products(src).groupBy(USER).agg(F.collect_list("product").alias("_set"))
    return agg.select(USER, F.array_sort("_set").alias("id_seen_products"),
                      F.size("_set").cast("bigint").alias("num_products"))


def value_set(src: DataFrame, col: str, out: str, n_out: str) -> DataFrame:
    """Sorted distinct non-NULL values per user (NULL when none) and their count (0 when none)."""
    distinct = src.groupBy(USER, F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    agg = distinct.groupBy(USER).agg(F.collect_list("_v").alias("_set"))  # NULL is no value, but keeps the user
    return agg.select(USER, nonempty_or_null(F.array_sort("_set")).alias(out),
                      F.size("_set").cast("bigint").alias(n_out))


def first_visit(src: DataFrame) -> DataFrame:
    return src.groupBy(USER).agg(F.min(TS).alias("first_visit_ts"))


SET_SPECS = [("campaign_ids", "id_campaigns", "num_campaigns", "campaings"),
             ("device_used", "used_devices", "num_devices", "used_devices"),
             ("page_referrer", "canal_id", "num_canals", "used_canals")]


def _fact_rows(src: DataFrame) -> DataFrame:
    """One row per event (kind ``stay``, value: its session) and one per value of a set that it adds (kind: the set),
    so that a single exchange brings all facts of a user together. Events without a user add no set values: they
    match no joined view. A session number and a value of a set share one text column; NULL session is NULL."""
    items = F.transform(F.col("item_ids"), lambda x: F.struct(F.lit("products").alias("kind"),
                                                              x.try_cast("bigint").cast("string").alias("value")))
    sets = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value")) for c, _, _, _ in SET_SPECS])
    known = F.when(F.col(USER).isNotNull(), F.concat(sets, F.coalesce(items, F.array_remove(sets, sets[0]))))
    own = F.array(F.struct(F.lit("stay").alias("kind"), F.col(SESSION).cast("string").alias("value")))
    values = F.filter(F.coalesce(known, F.array_remove(sets, sets[0])), lambda x: x["value"].isNotNull())
    return src.select(USER, EVENT, TS, F.explode(F.concat(own, F.array_distinct(values))).alias("fact"))


def user_features(src: DataFrame) -> DataFrame:
    """The 47-column per-user feature frame, from one scan and two aggregates.

    The first aggregate is by (user, kind, value): counters and time bounds of each session, and each value of a set
    once. It is a hash aggregate of plain counters, its keys spread a hot user over its sessions and values, and it
    is partial before the exchange. The second one, by user, reads these few rows and gathers the sets.
    """
    stay = F.col("kind") == "stay"
    facts = _fact_rows(src).select(USER, EVENT, TS, "fact.kind", "fact.value")
    counters = [F.count(F.lit(1)).alias("total_events")]
    counters += [F.count_if(F.col(EVENT) == F.lit(e)).alias(out) for out, e in config.COUNT_EVENTS + config.INT_FLAGS]
    counters += [F.count_if(F.col(EVENT) == F.lit(e)).alias(out) for out, e in config.BOOL_FLAGS]
    # MAX over a comparison is NULL when no event of the user has a name
    counters += [F.count(EVENT).alias("_named"), F.min(TS).alias("_from"), F.max(TS).alias("_to")]
    per = facts.groupBy(USER, "kind", "value").agg(*counters)
    session = stay & F.col("value").isNotNull()
    seconds = F.when(session, (F.col("_to") - F.col("_from")) / F.lit(1_000_000)).cast("double")
    total = lambda c: F.sum(F.when(stay, F.col(c)).otherwise(F.lit(0)))
    named = total("_named") > 0
    aggs = [total(c).alias(c) for c in ["total_events", *[o for o, _ in config.COUNT_EVENTS]]]
    aggs += [F.when(total(c) > 0, F.lit(1)).otherwise(F.lit(0)).alias(c) for c, _ in config.INT_FLAGS]
    aggs += [F.when(named, total(c) > 0).alias(c) for c, _ in config.BOOL_FLAGS]
    gathered = {k: F.collect_list(F.when(F.col("kind") == k, F.col("value"))) for k in
                ["products", *[c for c, _, _, _ in SET_SPECS]]}
    aggs += [g.alias(f"_s_{k}") for k, g in gathered.items()]
    aggs += [F.count_if(session).alias("_n_sessions"), F.min(F.when(stay, F.col("_from"))).alias("_first_visit"),
             F.round(F.avg(seconds), 0).cast("bigint").alias("_avg"), F.max(seconds).alias("_max"),
             F.round(F.sum(seconds), 0).cast("bigint").alias("_sum")]
    j = per.groupBy(USER).agg(*aggs)

    has_user = F.col(USER).isNotNull()
    had_session = has_user & (F.col("_n_sessions") > 0)
    products = F.array_sort(F.transform(F.col("_s_products"), lambda x: x.cast("bigint")))
    joined_cols: dict[str, Column] = {
        "total_sessions": F.when(had_session, F.col("_n_sessions")),
        "session_duration_avg": F.when(had_session, F.col("_avg")),
        "session_duration_max": F.when(had_session, F.col("_max")),
        "total_session_time": F.when(had_session, F.col("_sum")),
        "products": json_int_array_text(F.when(has_user, nonempty_or_null(products))),
        "num_products": F.when(has_user & (F.size(products) > 0), F.size(products).cast("bigint")),
        "first_visit_ts": F.when(has_user, F.col("_first_visit")),
    }
    for c, _, n_out, json_out in SET_SPECS:
        s = F.col(f"_s_{c}")
        joined_cols[json_out] = json_text_or_null(F.when(has_user, nonempty_or_null(F.array_sort(s))))
        joined_cols[n_out] = F.when(has_user, F.size(s).cast("bigint"))
    out = [F.col(USER)]
    out += [(_events_per_session() if c == "events_per_session" else F.col(c)).alias(c) for c in config.BEHAVIOUR_ORDER]
    out += [joined_cols[c].alias(c) for c in config.JOINED_ORDER]
    return j.select(*out)
