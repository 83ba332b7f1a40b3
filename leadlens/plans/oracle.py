"""DuckDB twins of the registered queries (the correctness oracle).

Each SQL string runs on the driver's pre-registered views (``events`` …) and re-derives the
same input shapes as ``leadlens.sources.fixtures`` with dialect-twin CTEs, then states the
written rules directly, independently of how the Spark side is planned.
"""
from __future__ import annotations

FX_FLAT = r"""
fx_flat AS (
  SELECT CASE WHEN event_type = 'error' THEN 'intraday_' || strftime(ts, '%Y%m%d') ELSE strftime(ts, '%Y%m%d') END AS suffix,
    epoch_us(ts) AS event_timestamp,
    CASE WHEN event_id % 211 = 0 THEN NULL ELSE 'U' || CAST(user_id AS VARCHAR) END AS user_pseudo_id,
    CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'generate_lead'
                    WHEN 'error' THEN 'book_call' ELSE event_type END AS event_name,
    'L' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS transaction_id,
    TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
    CASE WHEN event_id % 10 = 0 THEN '' ELSE 'page/' || CAST(event_id % 7 AS VARCHAR) END AS page_name,
    CASE WHEN event_id % 2 = 0 THEN 'https://x.example/p?gclid=a&utm_campaign=c' || CAST(event_id % 5 AS VARCHAR) || '&z=1'
         ELSE 'https://x.example/p' END AS page_location,
    CASE WHEN user_id % 4 = 0 THEN ' LANDING ' WHEN user_id % 4 = 1 THEN NULL ELSE 'main_site' END AS platform,
    CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'web_contacto' END AS form_name,
    'm' || CAST(user_id % 5 AS VARCHAR) AS market_site,
    CASE WHEN user_id % 2 = 0 THEN 'es' ELSE 'en' END AS language_site,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE epoch_us(ts) // 43200000000 END AS ga_session_id,
    user_id % 9 + 1 AS ga_session_number,
    CASE WHEN user_id % 7 = 0 THEN NULL ELSE 'ES' END AS user_country,
    'R' || CAST(user_id % 12 AS VARCHAR) AS user_province,
    'es-' || CAST(user_id % 4 AS VARCHAR) AS user_studies,
    json_extract_string(props, '$.k') AS item_a,
    'x' || json_extract_string(props, '$.k') AS item_b,
    CASE WHEN user_id % 6 = 0 THEN NULL ELSE 'c' || CAST(event_id % 3 AS VARCHAR) END AS campaign_ids,
    CASE WHEN user_id % 10 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS device_used,
    CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'ref' || CAST(event_id % 5 AS VARCHAR) END AS page_referrer,
    event_id, value
  FROM events
)"""

FX_LEADS = r"""
fx_leads AS (
  SELECT 'L' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS ld_mcs_id,
         ts AS ld_createdon,
         CASE WHEN value > 50 THEN 1 ELSE 0 END AS apd_es_matricula
  FROM events WHERE event_type = 'signup'
)"""

FX_HISTORY = r"""
fx_history AS (
  SELECT d.execution_date, CAST(d.execution_date AS TIMESTAMP) AS execution_timestamp,
         l.ld_mcs_id, l.ld_createdon, l.apd_es_matricula
  FROM fx_leads l
  JOIN (VALUES (DATE '2024-01-10'), (DATE '2024-01-20'), (DATE '2024-01-30')) d(execution_date)
    ON CAST(l.ld_createdon AS DATE) <= d.execution_date
)"""


def asof_cte(execution_date: str = "2024-01-31") -> str:
    return f"""
snapshot_input AS (
  SELECT h.* FROM fx_history h
  WHERE h.execution_date = (
    SELECT COALESCE(MAX(CASE WHEN execution_date <= DATE '{execution_date}' THEN execution_date END),
                    MIN(execution_date)) FROM fx_history)
)"""


def _date_parts(ts: str, name: str) -> str:
    return ", ".join(f"CAST({part}({ts}) AS INTEGER) AS {name}_{part}" for part in ("day", "month", "year"))


def dag_ctes(execution_date: str = "2024-01-31", maturity_days: int = 7) -> str:
    """The training table from the written rules, each rule as one step.

    ``span`` holds the two time limits as one row; the newest lead of a day and the single
    (user, session) of a lead are stated with windows.
    """
    since = f"DATE '{execution_date}' - INTERVAL 2 YEAR"
    return ",\n".join([FX_FLAT, FX_LEADS, FX_HISTORY, asof_cte(execution_date), f"""
base AS (
  SELECT * FROM fx_flat WHERE TRY_CAST(suffix AS INTEGER) IS NOT NULL AND length(suffix) = 8
    AND CAST(suffix AS INTEGER) >= CAST(strftime({since}, '%Y%m%d') AS INTEGER)
)""", f"""
purchases AS (
  SELECT user_pseudo_id, event_timestamp AS purchase_timestamp, {_date_parts('make_timestamp(event_timestamp)', 'purchase')},
    NULL::BIGINT AS lead_id, COLUMNS(['transaction_id', 'product_id', 'page_name', 'page_location', 'platform', 'form_name',
      'market_site', 'language_site', 'ga_session_id', 'ga_session_number', 'user_country', 'user_province', 'user_studies'])
  FROM base WHERE event_name = 'purchase'
)""", f"""
lead_rows AS (
  SELECT epoch_us(ld_createdon) AS ld_timestamp, {_date_parts('ld_createdon', 'lead')}, ld_mcs_id, apd_es_matricula
  FROM snapshot_input WHERE ld_createdon >= {since}
)""", f"""
span AS (
  SELECT lo, hi, ripe, CASE WHEN hi IS NOT NULL AND ripe IS NOT NULL THEN least(hi, ripe) END AS up
  FROM (SELECT MIN(event_timestamp) AS lo, MAX(event_timestamp) AS hi FROM base),
       (SELECT MAX(ld_timestamp) - {maturity_days * 86_400_000_000} AS ripe FROM lead_rows)
)""", """
lead_window AS (
  SELECT * FROM lead_rows WHERE ld_timestamp BETWEEN (SELECT lo FROM span) AND (SELECT up FROM span)
)""", """
latest_leads AS (
  SELECT * FROM lead_window
  QUALIFY row_number() OVER (PARTITION BY ld_mcs_id, make_date(lead_year, lead_month, lead_day)
                             ORDER BY ld_timestamp DESC, apd_es_matricula DESC NULLS LAST) = 1
)""", """
purchase_window AS (SELECT * FROM purchases WHERE purchase_timestamp <= (SELECT up FROM span))""", """
lead_purchases AS (
  SELECT DISTINCT lead_day, lead_month, lead_year, ld_mcs_id, apd_es_matricula, purchase_window.*
  FROM latest_leads JOIN purchase_window
    ON (transaction_id, purchase_year, purchase_month, purchase_day) = (ld_mcs_id, lead_year, lead_month, lead_day)
)""", """
visitor AS (
  SELECT *, user_pseudo_id || '|' || ga_session_id AS visit FROM lead_purchases
)""", """
valid_leads AS (
  SELECT ld_mcs_id FROM visitor GROUP BY ld_mcs_id HAVING MIN(visit) = MAX(visit)
)""", """
model_train AS (
  SELECT COLUMNS(['ld_mcs_id', 'apd_es_matricula', 'user_pseudo_id', 'product_id', 'page_name', 'page_location', 'platform',
    'form_name', 'market_site', 'language_site', 'ga_session_id', 'ga_session_number', 'user_country', 'user_province', 'user_studies'])
  FROM lead_purchases SEMI JOIN valid_leads USING (ld_mcs_id)
)"""])


def with_dag(select: str, **kw) -> str:
    return "WITH " + dag_ctes(**kw) + "\n" + select


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select
