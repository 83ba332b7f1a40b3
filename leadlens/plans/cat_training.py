"""Registered queries: sources, snapshot history and the training-table DAG."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..operators import training as T
from ..session import ensure_session
from ..sources import fixtures as fx
from ..sources import leads as L
from ..sources.events import base_events
from ..sources.sinks import roundtrip_table
from . import oracle as O
from .catalogue import register

EXEC = fx.FIXTURE_EXECUTION_DATE
D = "2024-01-31"


def _params(execution_date: dt.date = EXEC) -> config.RunParams:
    return config.RunParams(execution_date=execution_date, maturity_days=fx.FIXTURE_MATURITY_DAYS)


def dag(spark: SparkSession, sf_dir: str, execution_date: dt.date = EXEC) -> T.TrainingDag:
    ensure_session(spark)
    return T.build_training_dag(fx.event_shards(spark, sf_dir), fx.lead_history(spark, sf_dir),
                                _params(execution_date))


def ts_text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def date_text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd")


TS_SQL = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"
DATE_SQL = "strftime({c}, '%Y-%m-%d')"

SCAN_COLS = ["suffix", "event_timestamp", "user_pseudo_id", "event_name"]


@register("src_event_shards", O.with_dag("SELECT suffix, event_timestamp, user_pseudo_id, event_name FROM base"))
def q_src_event_shards(spark, sf_dir):
    """Daily shards only (8-digit suffix) from execution_date − 2 years."""
    return dag(spark, sf_dir).base.select(*SCAN_COLS)


@register("param_execution_date", O.with_dag(
    "SELECT suffix, event_timestamp, user_pseudo_id, event_name FROM base", execution_date="2026-01-15"))
def q_param_execution_date(spark, sf_dir):
    """Same scan with a later run date: the two-year floor now cuts the first shards."""
    return dag(spark, sf_dir, dt.date(2026, 1, 15)).base.select(*SCAN_COLS)


LEAD_SQL = ("SELECT ld_mcs_id, " + TS_SQL.format(c="ld_createdon") + " AS ld_createdon, apd_es_matricula FROM fx_leads")


@register("src_lead_table", O.with_ctes(O.FX_LEADS, select=LEAD_SQL))
def q_src_lead_table(spark, sf_dir):
    """CRM lead table rows (id, creation time as text, raw target)."""
    ensure_session(spark)
    leads = fx.lead_table(spark, sf_dir)
    return leads.select("ld_mcs_id", ts_text("ld_createdon").alias("ld_createdon"), config.RAW_TARGET)


def _history_text(df: DataFrame) -> DataFrame:
    return df.select(date_text("execution_date").alias("execution_date"),
                     ts_text("execution_timestamp").alias("execution_timestamp"),
                     "ld_mcs_id", ts_text("ld_createdon").alias("ld_createdon"), config.RAW_TARGET)


HIST_SQL = ("SELECT " + DATE_SQL.format(c="execution_date") + " AS execution_date, "
            + TS_SQL.format(c="execution_timestamp") + " AS execution_timestamp, ld_mcs_id, "
            + TS_SQL.format(c="ld_createdon") + " AS ld_createdon, apd_es_matricula FROM {src}")


@register("snap_append", O.with_ctes(O.FX_LEADS, select=HIST_SQL.format(
    src="(SELECT DATE '2024-01-31' AS execution_date, TIMESTAMP '2024-01-31 06:30:00' AS execution_timestamp, * FROM fx_leads)")))
def q_snap_append(spark, sf_dir):
    """Today's snapshot stamped with the injected run date and time."""
    ensure_session(spark)
    snap = L.snapshot_frame(fx.lead_table(spark, sf_dir), dt.date(2024, 1, 31), dt.datetime(2024, 1, 31, 6, 30))
    return _history_text(snap)


_REPLACE_SRC = """(
  SELECT execution_date, execution_timestamp, ld_mcs_id, ld_createdon, apd_es_matricula FROM fx_history
  WHERE execution_date <> DATE '{today}' AND execution_date >= DATE '{today}' - INTERVAL 2 YEAR
  UNION ALL
  SELECT DATE '{today}', TIMESTAMP '{today} 07:00:00', ld_mcs_id, ld_createdon, apd_es_matricula FROM fx_leads
)"""


def _after_append(spark, sf_dir, today: dt.date) -> DataFrame:
    ensure_session(spark)
    hist = fx.lead_history(spark, sf_dir)
    leads = fx.lead_table(spark, sf_dir)
    return _history_text(L.history_after_append(hist, leads, today, dt.datetime(today.year, today.month, today.day, 7)))


@register("snap_idempotent_replace", O.with_ctes(O.FX_LEADS, O.FX_HISTORY,
          select=HIST_SQL.format(src=_REPLACE_SRC.format(today="2024-01-20"))))
def q_snap_idempotent_replace(spark, sf_dir):
    """Rerun on a day that already has a snapshot: that day's rows are replaced, not doubled."""
    return _after_append(spark, sf_dir, dt.date(2024, 1, 20))


@register("snap_retention", O.with_ctes(O.FX_LEADS, O.FX_HISTORY,
          select=HIST_SQL.format(src=_REPLACE_SRC.format(today="2026-01-15"))))
def q_snap_retention(spark, sf_dir):
    """Append two years later: snapshots older than today − 2 years are dropped."""
    return _after_append(spark, sf_dir, dt.date(2026, 1, 15))


def _asof(spark, sf_dir, d: dt.date) -> DataFrame:
    ensure_session(spark)
    return _history_text(L.asof_snapshot(fx.lead_history(spark, sf_dir), d))


@register("snap_asof", O.with_ctes(O.FX_LEADS, O.FX_HISTORY, O.asof_cte("2024-01-25").lstrip(),
          select=HIST_SQL.format(src="snapshot_input")))
def q_snap_asof(spark, sf_dir):
    """Newest snapshot on or before 2024-01-25 (the 20th)."""
    return _asof(spark, sf_dir, dt.date(2024, 1, 25))


@register("asof_join", O.with_ctes(O.FX_LEADS, O.FX_HISTORY, O.asof_cte("2024-01-05").lstrip(),
          select=HIST_SQL.format(src="snapshot_input")))
def q_asof_join(spark, sf_dir):
    """No snapshot on or before 2024-01-05: falls back to the oldest one (the 10th)."""
    return _asof(spark, sf_dir, dt.date(2024, 1, 5))


@register("lead_normalise", O.with_dag("SELECT * FROM lead_rows"))
def q_lead_normalise(spark, sf_dir):
    """Chosen snapshot's leads as µs epoch, UTC calendar parts, id and target, within the two-year window."""
    return dag(spark, sf_dir).leads


@register("max_lead_maturity_cutoff", O.with_dag("SELECT ripe AS max_createdon FROM span"))
def q_max_lead_maturity_cutoff(spark, sf_dir):
    """Newest lead time minus the maturity window, in µs."""
    d = dag(spark, sf_dir)
    return T.maturity_cutoff_frame(d.leads, fx.FIXTURE_MATURITY_DAYS)


@register("event_ts_bounds", O.with_dag("SELECT lo AS min_timestamp, hi AS max_timestamp FROM span"))
def q_event_ts_bounds(spark, sf_dir):
    """Earliest and latest event time of the daily shards."""
    return T.event_ts_bounds_frame(dag(spark, sf_dir).base)


@register("lead_window", O.with_dag("SELECT * FROM lead_window"))
def q_lead_window(spark, sf_dir):
    """Leads created between the first event and the matured upper bound (both inclusive)."""
    return dag(spark, sf_dir).lead_window


@register("latest_lead_per_day", O.with_dag("SELECT * FROM latest_leads"))
def q_latest_lead_per_day(spark, sf_dir):
    """Latest lead per (id, UTC day) among the windowed leads (hash-aggregate dedup)."""
    return dag(spark, sf_dir).latest_leads


@register("purchase_events", O.with_dag("SELECT * FROM purchases"))
def q_purchase_events(spark, sf_dir):
    """Purchase events of the daily shards with every typed parameter extracted."""
    return dag(spark, sf_dir).purchases


_PROJ_SQL = """SELECT user_pseudo_id, event_timestamp AS purchase_timestamp,
  CAST(day(make_timestamp(event_timestamp)) AS INTEGER) AS purchase_day,
  CAST(month(make_timestamp(event_timestamp)) AS INTEGER) AS purchase_month,
  CAST(year(make_timestamp(event_timestamp)) AS INTEGER) AS purchase_year,
  CAST(NULL AS BIGINT) AS lead_id, transaction_id, product_id, page_name, page_location, platform,
  form_name, market_site, language_site, ga_session_id, ga_session_number,
  user_country, user_province, user_studies FROM base"""


@register("param_extract", O.with_dag(_PROJ_SQL))
def q_param_extract(spark, sf_dir):
    """Typed key lookup in event_params / user_properties for every daily-shard event."""
    return T.event_projection(dag(spark, sf_dir).base)


@register("array_scalar_subquery", O.with_dag(_PROJ_SQL))
def q_array_scalar_subquery(spark, sf_dir):
    """The same lookup in strict mode: a repeated key raises instead of taking the first."""
    return T.event_projection(dag(spark, sf_dir).base, strict=True)


@register("struct_project", O.with_dag(
    "SELECT event_timestamp, user_pseudo_id, user_country, user_province FROM base"))
def q_struct_project(spark, sf_dir):
    """Nested struct fields `geo.country` / `geo.region` projected as user country / province."""
    base = dag(spark, sf_dir).base
    return base.select("event_timestamp", "user_pseudo_id", F.col("geo.country").alias("user_country"),
                       F.col("geo.region").alias("user_province"))


@register("calendar_parts", O.with_dag("""SELECT event_timestamp,
  CAST(day(make_timestamp(event_timestamp)) AS INTEGER) AS event_day,
  CAST(month(make_timestamp(event_timestamp)) AS INTEGER) AS event_month,
  CAST(year(make_timestamp(event_timestamp)) AS INTEGER) AS event_year FROM base"""))
def q_calendar_parts(spark, sf_dir):
    """UTC day, month and year of each event's microsecond timestamp."""
    from ..functions.timeparts import calendar_parts
    base = dag(spark, sf_dir).base
    return base.select("event_timestamp", *calendar_parts(F.col("event_timestamp"), "event"))


@register("purchase_window", O.with_dag("SELECT * FROM purchase_window"))
def q_purchase_window(spark, sf_dir):
    """Purchases up to the matured upper bound (no lower bound)."""
    return dag(spark, sf_dir).purchase_window


@register("lead_purchase_join", O.with_dag("SELECT * FROM lead_purchases"))
def q_lead_purchase_join(spark, sf_dir):
    """Same-UTC-day purchase rows of each latest lead, distinct, without the lead time."""
    return dag(spark, sf_dir).joined


@register("column_except", O.with_dag("""SELECT ld_mcs_id, apd_es_matricula, user_pseudo_id, product_id,
  page_name, page_location, platform, form_name, market_site, language_site, ga_session_id,
  ga_session_number, user_country, user_province, user_studies FROM lead_purchases"""))
def q_column_except(spark, sf_dir):
    """The lead–purchase rows without the nine join/time columns (SELECT * EXCEPT)."""
    return T.column_except(dag(spark, sf_dir).joined, config.TRAINING_DROP)


@register("valid_leads", O.with_dag("SELECT * FROM valid_leads"))
def q_valid_leads(spark, sf_dir):
    """Leads whose purchase rows carry exactly one distinct non-NULL (user, session) pair."""
    return dag(spark, sf_dir).valid


@register("valid_lead_semijoin", O.with_dag(
    "SELECT l.* FROM lead_purchases l JOIN valid_leads vl ON l.ld_mcs_id = vl.ld_mcs_id"))
def q_valid_lead_semijoin(spark, sf_dir):
    """Lead–purchase rows of leads with exactly one (user, session) pair."""
    d = dag(spark, sf_dir)
    return T.valid_lead_semijoin(d.joined, d.valid)


@register("model_train", O.with_dag("SELECT * FROM model_train"))
def q_model_train(spark, sf_dir):
    """Flagship: the labelled training table (maturity 7 days on the 30-day fixture)."""
    return dag(spark, sf_dir).table


@register("sink_training_table", O.with_dag("SELECT * FROM model_train"))
def q_sink_training_table(spark, sf_dir):
    """Materialise the training table (full rebuild) and read it back."""
    return roundtrip_table(spark, dag(spark, sf_dir).table, "model_train")


@register("src_event_shards_stored", O.with_dag("SELECT suffix, event_timestamp, user_pseudo_id, event_name FROM base"))
def q_src_event_shards_stored(spark, sf_dir):
    """Shards written as one dataset partitioned by ``suffix`` and scanned back: the
    8-digit / two-year rule is a literal partition filter (pruned folders are never read)."""
    from ..sources.events import read_event_shards, write_event_shards
    from ..session import scratch_path
    ensure_session(spark)
    path = scratch_path(spark, "event_shards")
    write_event_shards(fx.event_shards(spark, sf_dir), path)
    return base_events(read_event_shards(spark, path), EXEC).select(*SCAN_COLS)


@register("snap_asof_stored", O.with_ctes(O.FX_LEADS, O.FX_HISTORY, O.asof_cte("2024-01-25").lstrip(),
          select=HIST_SQL.format(src="snapshot_input")))
def q_snap_asof_stored(spark, sf_dir):
    """History built by three physical daily appends, then the as-of snapshot for 2024-01-25
    read with the chosen date as a run-time partition filter."""
    from ..session import scratch_path
    ensure_session(spark)
    path = scratch_path(spark, "lead_history")
    leads = fx.lead_table(spark, sf_dir)
    for d in fx.FIXTURE_SNAPSHOT_DAYS:
        L.append_snapshot(spark, leads.filter(F.to_date("ld_createdon") <= F.lit(d)), path, d,
                          dt.datetime(d.year, d.month, d.day))
    return _history_text(L.asof_snapshot(L.read_history(spark, path), dt.date(2024, 1, 25)))


_CYCLE_SRC = """(
  SELECT DATE '2024-01-10' AS execution_date, TIMESTAMP '2024-01-10 09:00:00' AS execution_timestamp, *
  FROM fx_leads WHERE CAST(ld_createdon AS DATE) <= DATE '2024-01-10'
  UNION ALL
  SELECT DATE '2026-01-05', TIMESTAMP '2026-01-05 07:00:00', * FROM fx_leads
)"""


@register("snap_replace_stored", O.with_ctes(O.FX_LEADS, select=HIST_SQL.format(src=_CYCLE_SRC)))
def q_snap_replace_stored(spark, sf_dir):
    """Six physical appends, each one manifest: two days, a rerun of the second, a day that a rerun without leads
    clears, and one two years later that expires the first; then the whole history as a reader sees it."""
    from ..session import scratch_path
    ensure_session(spark)
    path = scratch_path(spark, "lead_history")
    leads = fx.lead_table(spark, sf_dir)
    until = lambda d: leads.filter(F.to_date("ld_createdon") <= F.lit(d))
    first, second, cleared = dt.date(2024, 1, 2), dt.date(2024, 1, 10), dt.date(2024, 1, 15)
    for d, rows, hour in ((first, until(first), 7), (second, leads, 7), (second, until(second), 9), (cleared, leads, 7),
                          (cleared, leads.filter(F.lit(False)), 8), (dt.date(2026, 1, 5), leads, 7)):
        L.append_snapshot(spark, rows, path, d, dt.datetime(d.year, d.month, d.day, hour))
    return _history_text(L.read_history(spark, path))


def _stored_shards(spark, sf_dir) -> str:
    """All shards on storage: written in two appends, the last third without statistics."""
    from ..session import scratch_path
    from ..sources.events import write_event_shards
    path = scratch_path(spark, "event_shards")
    shards = fx.event_shards(spark, sf_dir)
    late = F.col("suffix") >= "20240121"
    write_event_shards(shards.filter(F.col("suffix") < "20240111"), path)
    write_event_shards(shards.filter((F.col("suffix") >= "20240111") & ~late), path, "append")
    shards.filter(late).write.mode("append").partitionBy("suffix").parquet(path)
    return path


@register("event_ts_bounds_stored", O.with_dag("SELECT lo AS min_timestamp, hi AS max_timestamp FROM span"))
def q_event_ts_bounds_stored(spark, sf_dir):
    """The two time bounds from the statistics of stored shards; events are read of shards without statistics only."""
    from ..sources.events import event_bounds
    ensure_session(spark)
    return event_bounds(spark, _stored_shards(spark, sf_dir), EXEC)


@register("model_train_stored", O.with_dag("SELECT * FROM model_train"))
def q_model_train_stored(spark, sf_dir):
    """The training table over stored shards, its time bounds from their statistics."""
    from ..sources import events as EV
    ensure_session(spark)
    path = _stored_shards(spark, sf_dir)
    EV.refresh_shard_stats(spark, path)
    return T.build_training_dag(EV.read_event_shards(spark, path), fx.lead_history(spark, sf_dir), _params(),
                                EV.event_bounds(spark, path, EXEC)).table
