"""The labelled training table: leads joined with same-day purchase events.

DAG (all lazy DataFrame functions; Catalyst sees one plan):

    shards ─ base_events ─┬─ event_ts_bounds ──────────────┐
                          └─ purchase_events ─ purchase_window ─┐
    history ─ asof_snapshot ─ lead_normalise ─ maturity_cutoff ─┤
                              └─ lead_window ─ latest_lead_per_day ─ lead_purchase_join
                                                   ─ valid_leads ─ valid_lead_semijoin ─ model_train

Scale notes: the three global bounds are scalar subqueries (one merged scan of the
timestamp column, no cross join); the per-day dedup is an aggregate, so a hot lead id is
collapsed map-side before the shuffle; validity is a distinct count (hash aggregates, first
keyed by lead and pair) followed by a left-semi join that AQE may split when one lead holds
many rows.
"""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.params import extract_params, param_value
from ..functions.safe import strict_least
from ..functions.timeparts import add_months_py, calendar_parts, micros_of

PURCHASE_COLUMNS = [
    "user_pseudo_id", "purchase_timestamp", "purchase_day", "purchase_month", "purchase_year",
    "lead_id", "transaction_id", "product_id", "page_name", "page_location", "platform", "form_name",
    "market_site", "language_site", "ga_session_id", "ga_session_number", "user_country",
    "user_province", "user_studies",
]
LEAD_WINDOW_COLUMNS = ["ld_timestamp", "lead_day", "lead_month", "lead_year", "ld_mcs_id", config.RAW_TARGET]


def event_projection(base: DataFrame, strict: bool = True) -> DataFrame:
    """Flatten one analytics event: typed parameters, geo parts, user property (no filter)."""
    return base.select(
        F.col("user_pseudo_id"),
        F.col("event_timestamp").alias("purchase_timestamp"),
        *calendar_parts(F.col("event_timestamp"), "purchase"),
        *extract_params("event_params", config.EVENT_PARAM_KEYS, strict),
        F.col("geo.country").alias("user_country"),
        F.col("geo.region").alias("user_province"),
        *[param_value("user_properties", key, slot, strict).alias(out) for out, key, slot in config.USER_PROPERTY_KEYS],
    )


def purchase_events(base: DataFrame, strict: bool = True) -> DataFrame:
    """Purchase events with their parameters extracted (filter first: it reaches the scan)."""
    return event_projection(base.filter(F.col("event_name") == "purchase"), strict)


def event_ts_bounds(base: DataFrame) -> tuple[Column, Column]:
    """(min, max) event time as scalar subqueries; Spark merges them into one aggregate."""
    ts = F.col("event_timestamp")
    return base.agg(F.min(ts)).scalar(), base.agg(F.max(ts)).scalar()


def lead_normalise(snapshot: DataFrame, execution_date: dt.date,
                   lookback_months: int = config.LOOKBACK_MONTHS) -> DataFrame:
    """Lead → µs epoch, UTC day/month/year, id, target; keeps leads from the look-back window."""
    created = F.to_timestamp(F.col("ld_createdon"))
    us = micros_of(F.col("ld_createdon"))
    floor = add_months_py(execution_date, -lookback_months)
    return (snapshot.filter(F.to_date(created) >= F.lit(floor))
            .select(us.alias("ld_timestamp"),
                    F.dayofmonth(created).alias("lead_day"), F.month(created).alias("lead_month"),
                    F.year(created).alias("lead_year"),
                    F.col("ld_mcs_id"), F.col(config.RAW_TARGET)))


def maturity_cutoff(leads: DataFrame, maturity_days: int = config.MATURITY_DAYS) -> Column:
    """Scalar: newest lead time minus the maturity window, in µs."""
    return leads.agg(F.max("ld_timestamp") - F.lit(maturity_days * config.MICROS_PER_DAY)).scalar()


def maturity_cutoff_frame(leads: DataFrame, maturity_days: int = config.MATURITY_DAYS) -> DataFrame:
    return leads.agg((F.max("ld_timestamp") - F.lit(maturity_days * config.MICROS_PER_DAY)).alias("max_createdon"))


def event_ts_bounds_frame(base: DataFrame) -> DataFrame:
    ts = F.col("event_timestamp")
    return base.agg(F.min(ts).alias("min_timestamp"), F.max(ts).alias("max_timestamp"))


@dataclass
class Bounds:
    min_ts: Column
    max_ts: Column
    max_createdon: Column

    @property
    def upper(self) -> Column:
        # NULL when either side is NULL (warehouse LEAST), so empty inputs select nothing.
        return strict_least(self.max_createdon, self.max_ts)


def bounds(base: DataFrame, leads: DataFrame, maturity_days: int, event_span: DataFrame | None = None) -> Bounds:
    """``event_span``: (min_timestamp, max_timestamp) where they are known without a scan of ``base``."""
    lo, hi = event_ts_bounds(base) if event_span is None else (event_span.select("min_timestamp").scalar(),
                                                               event_span.select("max_timestamp").scalar())
    return Bounds(lo, hi, maturity_cutoff(leads, maturity_days))


def lead_window(leads: DataFrame, b: Bounds) -> DataFrame:
    """Leads created between the first event and the matured upper bound, both inclusive."""
    ts = F.col("ld_timestamp")
    return leads.filter((ts <= b.upper) & (ts >= b.min_ts))


def latest_lead_per_day(leads: DataFrame) -> DataFrame:
    """Latest lead per (id, UTC day): ``row_number() over (… order by ts desc) = 1``.

    Written as an aggregate so partial aggregation keeps one row per key per map task: a
    hot id (or the NULL id group) never lands whole in one task. The order key packs the
    timestamp with a tiebreak rank of the 0/1 target (1 before 0 before NULL), so the
    aggregate buffers are fixed-width longs and Spark runs it as a hash aggregate.
    """
    keys = ["ld_mcs_id", "lead_day", "lead_month", "lead_year"]
    y = F.col(config.RAW_TARGET)
    tie = F.when(y.isNull(), F.lit(0)).when(y >= 1, F.lit(2)).otherwise(F.lit(1))
    order = F.col("ld_timestamp") * F.lit(4) + tie
    agg = leads.groupBy(*keys).agg(F.max(order).alias("_k"), F.max_by(y, order).alias("_y"))
    ts = ((F.col("_k") - F.pmod(F.col("_k"), F.lit(4))) / F.lit(4)).cast("bigint")
    return agg.select(ts.alias("ld_timestamp"), "lead_day", "lead_month", "lead_year", "ld_mcs_id",
                      F.col("_y").cast(leads.schema[config.RAW_TARGET].dataType).alias(config.RAW_TARGET))


def purchase_window(purchases: DataFrame, b: Bounds) -> DataFrame:
    """Purchases up to the matured upper bound (no lower bound, by contract)."""
    return purchases.filter(F.col("purchase_timestamp") <= b.upper)


def lead_purchase_join(leads: DataFrame, purchases: DataFrame) -> DataFrame:
    """Same-UTC-day purchase rows of each lead, distinct, without the lead timestamp."""
    a, p = leads.alias("a"), purchases.alias("p")
    cond = ((F.col("p.transaction_id") == F.col("a.ld_mcs_id"))
            & (F.col("p.purchase_day") == F.col("a.lead_day"))
            & (F.col("p.purchase_month") == F.col("a.lead_month"))
            & (F.col("p.purchase_year") == F.col("a.lead_year")))
    cols = [F.col(f"a.{c}") for c in LEAD_WINDOW_COLUMNS if c != "ld_timestamp"] + \
           [F.col(f"p.{c}") for c in PURCHASE_COLUMNS]
    return a.join(p, cond, "inner").select(*cols).distinct()


def lead_session_key(df: DataFrame) -> Column:
    """``user|session`` text; NULL when either part is NULL (NULL-propagating concat)."""
    return F.concat(F.col("user_pseudo_id").cast("string"), F.lit("|"), F.col("ga_session_id").cast("string"))


def valid_leads(joined: DataFrame) -> DataFrame:
    """Leads with exactly one distinct non-NULL (user, session) pair.

    A single distinct count plans as hash aggregates: first keyed by (lead, pair), which
    dedups map-side and spreads a hot lead over many tasks, then by lead.
    """
    k = lead_session_key(joined)
    agg = joined.groupBy("ld_mcs_id").agg(F.count_distinct(k).alias("_pairs"))
    return agg.filter(F.col("_pairs") == 1).select("ld_mcs_id")


def valid_lead_semijoin(joined: DataFrame, valid: DataFrame) -> DataFrame:
    return joined.join(valid, on="ld_mcs_id", how="left_semi").select(*joined.columns)


def column_except(df: DataFrame, drop: list[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in set(drop)])


def model_train(joined: DataFrame) -> DataFrame:
    """Final training table: valid leads' rows minus the join keys and purchase time.

    Grain is one row per (lead-day, purchase event) deduplicated before the purchase time
    is dropped, so identical output rows are legal and kept.
    """
    return column_except(valid_lead_semijoin(joined, valid_leads(joined)), config.TRAINING_DROP)


@dataclass
class TrainingDag:
    """Every intermediate of one build, for inspection and for the query catalogue.

    ``table`` materialises the (small) lead–purchase join once as a parquet table in the
    shared checkpoint folder before the validity aggregate and the semi-join both read it, so
    the event shards are scanned for purchases once, not twice.
    """
    base: DataFrame
    purchases: DataFrame
    snapshot: DataFrame
    leads: DataFrame
    bounds: Bounds
    lead_window: DataFrame
    latest_leads: DataFrame
    purchase_window: DataFrame
    joined: DataFrame
    valid: DataFrame
    materialize: bool = True
    _table: DataFrame | None = None

    @property
    def table(self) -> DataFrame:
        if self._table is None:
            joined = self.joined
            if self.materialize:
                from ..sources.sinks import roundtrip_table
                # parquet in the shared folder: columnar, so validity reads three columns
                joined = roundtrip_table(joined.sparkSession, joined, "lead_purchases")
            self._table = model_train(joined)
        return self._table


def build_training_dag(shards: DataFrame, history: DataFrame, params: config.RunParams,
                       event_span: DataFrame | None = None) -> TrainingDag:
    """``event_span`` (see ``sources.events.event_bounds``) spares the scan of all shards for the two time bounds."""
    from ..sources.events import base_events
    from ..sources.leads import asof_snapshot

    base = base_events(shards, params.execution_date, params.lookback_months, params.upper_bound)
    purchases = purchase_events(base, params.strict_params)
    snap = asof_snapshot(history, params.execution_date)
    leads = lead_normalise(snap, params.execution_date, params.lookback_months)
    b = bounds(base, leads, params.maturity_days, event_span)
    lw = lead_window(leads, b)
    latest = latest_lead_per_day(lw)
    pw = purchase_window(purchases, b)
    joined = lead_purchase_join(latest, pw)
    valid = valid_leads(joined)
    return TrainingDag(base, purchases, snap, leads, b, lw, latest, pw, joined, valid, params.materialize)
