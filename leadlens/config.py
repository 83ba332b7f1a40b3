"""Contract constants and run parameters.

Everything a result depends on lives here so the rest of the code is free of literals.
"""
from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values of the data contract (they must equal the reference's values for
# results to match; listed plainly, in their natural order).
# ---------------------------------------------------------------------------
TARGET = "y"
RAW_TARGET = "apd_es_matricula"
SEGMENT_COL = "segmento"
ID_COLS = ["event_timestamp", "user_pseudo_id", "ga_session_id", "transaction_id", "ld_mcs_id"]
SEGMENTS = ["landing", "main"]
LANDING = "landing"
MAIN = "main"
FEATURE_OVERRIDES: dict[str, list[str]] = {
    "landing": ["ga_session_number", "user_studies", "language_site", "utm_campaign", "page_path"],
    "main": ["ga_session_number", "product_id", "user_country", "user_province", "user_studies",
             "form_name", "page_name"],
}
PROMOTION = {"metric": "lift_A", "min_abs": 1.0, "max_regression": 0.15}
GRADE_BANDS = [("A", 75), ("B", 50)]
GRADE_FALLBACK = "C"
GRADE_LETTERS = {"main": ["A", "B", "C"], "landing": ["D", "E", "F"]}
CAPACITY_CUTS = (2, 5, 10, 15, 20, 30, 50, 60, 70, 80, 90)
MISSING = "MISSING"
MIN_FREQUENCY = 20
UTM_CAMPAIGN_PATTERN = r"[?&]utm_campaign=([^&]+)"
DERIVED_COLUMNS = ("page_path", "utm_campaign")
SHARD_SUFFIX_PATTERN = r"^\d{8}$"
LOOKBACK_MONTHS = 24
MATURITY_DAYS = 30
DAILY_VOLUME = 250
N_SEEDS = 5
N_ITER = 60
N_FOLDS = 4
SEARCH_ROUNDS = 400
MAX_ROUNDS = 2000
EARLY_STOP_ROUNDS = 50
MIN_ROUNDS = 10
SPLIT_TEST = 0.30
SPLIT_EVAL_OF_REST = 2 / 3
TOP_FRACTION = 0.10
ROC_POINTS = 200
RELOAD_INTERVAL_S = 300
SCHEMA_VERSION = 2
# Behaviour counters in output order: (output column, event name, kind) where kind is
# "all" = COUNT(*), "count" = COUNTIF(event_name = X), "int_flag" = MAX(IF(event_name = X, 1, 0)),
# "bool_flag" = MAX(event_name = X), "per_session" = COUNT(*) / COUNT(DISTINCT session).
BEHAVIOUR_COLUMNS = [
    ("total_events", None, "all"),
    ("total_purchase", "purchase", "count"),
    ("total_pageviews", "page_view", "count"),
    ("events_per_session", None, "per_session"),
    ("total_scrolls", "scroll", "count"),
    ("total_user_engagement", "user_engagement", "count"),
    ("total_view_item", "view_item", "count"),
    ("total_select_item", "select_item", "count"),
    ("total_add_to_cart", "add_to_cart", "count"),
    ("total_begin_checkout", "begin_checkout", "count"),
    ("total_form_start", "form_start", "count"),
    ("form_success_flag", "form_success", "int_flag"),
    ("form_success_flag_unbounce_flag", "form_success_unbounce", "bool_flag"),
    ("generate_lead_flag", "generate_lead", "int_flag"),
    ("total_open_form", "open_form", "count"),
    ("book_call_flag", "book_call", "bool_flag"),
    ("call_to_phone_flag", "call_to_phone", "bool_flag"),
    ("total_video_start", "video_start", "count"),
    ("total_video_progress", "video_progress", "count"),
    ("video_complete_flag", "video_complete", "int_flag"),
    ("chat_open_flag", "open_chat", "bool_flag"),
    ("chat_start_flag", "chat_start", "bool_flag"),
    ("chat_success_flag", "chat_success", "bool_flag"),
    ("total_popup_clicks", "click_popup_banner", "count"),
    ("total_clicks", "click", "count"),
    ("total_click_slide", "click_slide", "count"),
    ("total_file_download", "file_download", "count"),
    ("total_view_content", "view_content", "count"),
    ("total_view_item_list", "view_item_list", "count"),
    ("total_view_popup_banner", "view_popup_banner", "count"),
    ("total_search", "search", "count"),
    ("total_session_start", "session_start", "count"),
    ("total_first_visit", "first_visit", "count"),
]
BEHAVIOUR_ORDER = [c for c, _, _ in BEHAVIOUR_COLUMNS]
COUNT_EVENTS = [(c, e) for c, e, k in BEHAVIOUR_COLUMNS if k == "count"]
INT_FLAGS = [(c, e) for c, e, k in BEHAVIOUR_COLUMNS if k == "int_flag"]
BOOL_FLAGS = [(c, e) for c, e, k in BEHAVIOUR_COLUMNS if k == "bool_flag"]
JOINED_ORDER = [
    "total_sessions", "session_duration_avg", "session_duration_max", "total_session_time",
    "products", "num_products", "campaings", "num_campaigns", "used_devices", "num_devices",
    "used_canals", "num_canals", "first_visit_ts",
]
# Event-parameter keys pulled from event_params: (output column, key, value slot).
EVENT_PARAM_KEYS = [
    ("lead_id", "lead_id", "int_value"),
    ("transaction_id", "transaction_id", "string_value"),
    ("product_id", "product_id", "int_value"),
    ("page_name", "page_name", "string_value"),
    ("page_location", "page_location", "string_value"),
    ("platform", "platform", "string_value"),
    ("form_name", "form_name", "string_value"),
    ("market_site", "market_site", "string_value"),
    ("language_site", "language_site", "string_value"),
    ("ga_session_id", "ga_session_id", "int_value"),
    ("ga_session_number", "ga_session_number", "int_value"),
]
USER_PROPERTY_KEYS = [("user_studies", "user_studies", "string_value")]
# Columns of the lead/purchase join that the final training table drops.
TRAINING_DROP = ["lead_day", "lead_month", "lead_year", "purchase_day", "purchase_month",
                 "purchase_year", "lead_id", "transaction_id", "purchase_timestamp"]

MICROS_PER_DAY = 86_400_000_000


def canonical_grades() -> list[str]:
    return [g for g, _ in GRADE_BANDS] + [GRADE_FALLBACK]


def band_uppers() -> list[int]:
    """Cumulative upper edge (percent from the top) of each grade band: A 25, B 50, C 100."""
    return [100 - q for _, q in GRADE_BANDS] + [100]


@dataclass(frozen=True)
class RunParams:
    """Parameters of one training-table build.

    ``execution_date`` drives the two-year look-back and the as-of snapshot choice;
    ``today``/``now`` stamp the snapshot history (passed in; when unset, the execution date and
    its midnight are used); ``execution_date`` defaults to the current UTC date;
    ``maturity_days`` is the label-maturity window (30 in production); ``strict_params`` makes a
    repeated event parameter an error, as the warehouse does, instead of taking the first;
    ``upper_bound`` keeps shards after the execution date out, for reproducible back-fills.
    """

    execution_date: _dt.date = field(default_factory=lambda: _dt.datetime.now(_dt.timezone.utc).date())
    today: _dt.date | None = None
    now: _dt.datetime | None = None
    maturity_days: int = MATURITY_DAYS
    lookback_months: int = LOOKBACK_MONTHS
    strict_params: bool = True
    upper_bound: bool = False
    materialize: bool = True

    @property
    def snapshot_date(self) -> _dt.date:
        return self.today or self.execution_date

    @property
    def snapshot_ts(self) -> _dt.datetime:
        if self.now is not None:
            return self.now
        d = self.snapshot_date
        return _dt.datetime(d.year, d.month, d.day)
