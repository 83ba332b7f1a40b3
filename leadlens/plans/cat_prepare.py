"""Registered queries: training-frame load, routing, derived columns, encoding, stats."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..operators import prepare as P
from ..operators import training as T
from ..sources.sinks import read_stage, write_stage
from ..session import scratch_path
from . import oracle as O
from .cat_training import dag
from .catalogue import register

LOADED_SQL = """SELECT ld_mcs_id, apd_es_matricula AS y, user_pseudo_id, product_id, page_name, page_location, platform,
  form_name, market_site, language_site, ga_session_id, ga_session_number, user_country, user_province, user_studies,
  CASE WHEN lower(trim(platform)) = 'landing' THEN 'landing' ELSE 'main' END AS segmento,
  NULLIF(page_name, '') AS page_path,
  NULLIF(regexp_extract(page_location, '[?&]utm_campaign=([^&]+)', 1), '') AS utm_campaign
FROM model_train"""
LOADED = f"""
loaded AS ({LOADED_SQL})"""


def psql(select: str, *extra: str) -> str:
    return "WITH " + O.dag_ctes() + ",\n" + ",\n".join([LOADED, *extra]) + "\n" + select


def loaded(spark, sf_dir):
    return P.load_training_frame(dag(spark, sf_dir).table)


@register("src_training_table", psql("SELECT * FROM loaded"))
def q_src_training_table(spark, sf_dir):
    """Training table as the trainer reads it: target renamed, segment added, columns derived."""
    return loaded(spark, sf_dir)


@register("target_rename", O.with_dag("SELECT * EXCLUDE (apd_es_matricula), apd_es_matricula AS y FROM model_train"))
def q_target_rename(spark, sf_dir):
    """Training table with the raw target renamed to `y` (only when `y` is absent)."""
    return P.apply_target_rename(dag(spark, sf_dir).table)


@register("segment_route", psql("SELECT ld_mcs_id, platform, segmento FROM loaded"))
def q_segment_route(spark, sf_dir):
    """Segment of each training row from its platform (trimmed, lower-cased `landing`, else main)."""
    return loaded(spark, sf_dir).select("ld_mcs_id", "platform", config.SEGMENT_COL)


@register("segment_filter", psql("SELECT * FROM loaded WHERE segmento = 'landing'"))
def q_segment_filter(spark, sf_dir):
    """The landing-segment rows of the prepared training frame."""
    return P.segment_frame(loaded(spark, sf_dir), config.LANDING)


@register("derive_page_path", O.with_dag("SELECT event_timestamp, page_name, NULLIF(page_name, '') AS page_path FROM base"))
def q_derive_page_path(spark, sf_dir):
    """`page_path` = the page label when non-empty, else NULL, for every daily-shard event."""
    proj = T.event_projection(dag(spark, sf_dir).base)
    return P.derive_columns(proj).select(F.col("purchase_timestamp").alias("event_timestamp"), "page_name", "page_path")


@register("derive_utm_campaign", O.with_dag(
    "SELECT event_timestamp, page_location, NULLIF(regexp_extract(page_location, '[?&]utm_campaign=([^&]+)', 1), '') AS utm_campaign FROM base"))
def q_derive_utm_campaign(spark, sf_dir):
    """`utm_campaign` = first `utm_campaign` query value of the page URL, else NULL."""
    proj = T.event_projection(dag(spark, sf_dir).base)
    return P.derive_columns(proj).select(F.col("purchase_timestamp").alias("event_timestamp"), "page_location", "utm_campaign")


@register("limit_rows", O.with_dag("SELECT COUNT(*) AS n_rows FROM (SELECT * FROM model_train LIMIT 100)"))
def q_limit_rows(spark, sf_dir):
    """Optional row cap on load (the cap is the feature): how many rows a 100-row load returns."""
    return P.load_training_frame(dag(spark, sf_dir).table, limit=100).agg(F.count(F.lit(1)).alias("n_rows"))


def _feature_rows(spark, sf_dir):
    df = loaded(spark, sf_dir)
    rows = []
    for seg in config.SEGMENTS + ["dynamic"]:
        over = config.FEATURE_OVERRIDES.get(seg)
        feats = P.resolve_features(df.columns, override=over)
        num, cat = P.split_types(df.schema, feats)
        for i, f in enumerate(feats):
            rows.append((seg, i, f, "numeric" if f in num else "categorical"))
    return spark.createDataFrame(rows, "segment string, position int, feature string, kind string")


def _schema_sql(select: str) -> str:
    """Feature lists from DuckDB's own schema of the loaded frame (contract constants only)."""
    excluded = ", ".join(repr(c) for c in config.ID_COLS + [config.TARGET, config.SEGMENT_COL])
    ov = ", ".join(f"('{seg}', {i}, '{c}')" for seg, feats in config.FEATURE_OVERRIDES.items() for i, c in enumerate(feats))
    ids = ", ".join(repr(c) for c in config.ID_COLS)
    return f"""WITH cols AS (
  SELECT column_name AS c, column_type AS t, row_number() OVER () AS ord FROM (DESCRIBE ({psql("SELECT * FROM loaded")}))
),
dyn AS (SELECT 'dynamic' AS segment, c, t, row_number() OVER (ORDER BY ord) - 1 AS position
        FROM cols WHERE c NOT IN ({excluded})),
ov AS (SELECT * FROM (VALUES {ov}) o(segment, opos, c)),
ovr AS (SELECT o.segment, o.c, cols.t, row_number() OVER (PARTITION BY o.segment ORDER BY o.opos) - 1 AS position
        FROM ov o JOIN cols ON cols.c = o.c WHERE o.c NOT IN ({excluded})),
allf AS (SELECT segment, c, t, position FROM dyn UNION ALL SELECT segment, c, t, position FROM ovr),
typed AS (SELECT *, CASE WHEN (t IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'HUGEINT', 'FLOAT', 'DOUBLE', 'BOOLEAN')
                               OR t LIKE 'DECIMAL%') AND NOT (c LIKE '%\\_id' ESCAPE '\\' OR c IN ({ids}))
                          THEN 'numeric' ELSE 'categorical' END AS kind FROM allf)
{select}"""


@register("resolve_features", _schema_sql("SELECT segment, CAST(position AS INTEGER) AS position, c AS feature FROM typed"))
def q_resolve_features(spark, sf_dir):
    """Feature list per segment (override order kept) and for the dynamic schema."""
    return _feature_rows(spark, sf_dir).select("segment", "position", "feature")


@register("split_types", _schema_sql("SELECT segment, c AS feature, kind FROM typed"))
def q_split_types(spark, sf_dir):
    """Numeric vs categorical per resolved feature (id-like numerics are categorical)."""
    return _feature_rows(spark, sf_dir).select("segment", "feature", "kind")


def _segment(spark, sf_dir, segment: str):
    """Rows of a segment with its numeric and categorical features."""
    df = P.segment_frame(loaded(spark, sf_dir), segment)
    num, cat = P.split_types(df.schema, P.resolve_features(df.columns, override=config.FEATURE_OVERRIDES[segment]))
    return df, num, cat


def _each_segment(build):
    """``build(segment)`` of all segments, with the segment's name, as one frame."""
    frames = [build(seg).withColumn("segment", F.lit(seg)) for seg in config.SEGMENTS]
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


NUMERIC = ["ga_session_number"]


def _prep_sql() -> str:
    parts = []
    for seg, feats in config.FEATURE_OVERRIDES.items():
        for f in feats:
            value = f"CAST({f} AS DOUBLE) AS num, NULL::VARCHAR AS cat" if f in NUMERIC else f"NULL::DOUBLE AS num, CAST({f} AS VARCHAR) AS cat"
            parts.append(f"SELECT '{seg}' AS segment, ld_mcs_id, y, '{f}' AS feature, {value} FROM loaded WHERE segmento = '{seg}'")
    return " UNION ALL ".join(parts)


@register("prep_features", psql(_prep_sql()))
def q_prep_features(spark, sf_dir):
    """Model frame of each segment, one row per feature: numerics as double (NULL kept), categoricals as text."""
    def build(seg):
        df, num, cat = _segment(spark, sf_dir, seg)
        wide = P.prep_features(df, num, cat, keep=["ld_mcs_id", config.TARGET])
        cell = lambda f: F.struct(F.lit(f).alias("feature"), (F.col(f) if f in num else F.lit(None)).cast("double").alias("num"),
                                  (F.col(f) if f in cat else F.lit(None)).cast("string").alias("cat"))
        return wide.select("ld_mcs_id", config.TARGET, F.explode(F.array(*map(cell, num + cat))).alias("c")).select(
            "ld_mcs_id", config.TARGET, "c.feature", "c.num", "c.cat")
    return _each_segment(build)


@register("num_passthrough", psql("""SELECT segmento AS segment, ld_mcs_id, COALESCE(CAST(ga_session_number AS DOUBLE), -1.0e9) AS ga_session_number__val,
  CAST(ga_session_number IS NULL AS DOUBLE) AS ga_session_number__missing FROM loaded"""))
def q_num_passthrough(spark, sf_dir):
    """Numeric model columns of each segment: sentinel-filled value and 0/1 missing indicator."""
    def build(seg):
        df, num, cat = _segment(spark, sf_dir, seg)
        prepped = P.prep_features(df, num, cat, keep=["ld_mcs_id"])
        return prepped.select("ld_mcs_id", *P.num_passthrough(prepped, num))
    return _each_segment(build)


_CAT = [f for f in config.FEATURE_OVERRIDES["main"] if f not in NUMERIC]


def _levels_sql() -> str:
    return " UNION ALL ".join(f"SELECT '{seg}' AS segment, '{f}' AS feature, COALESCE(CAST({f} AS VARCHAR), 'MISSING') AS level "
                              f"FROM loaded WHERE segmento = '{seg}'"
                              for seg, feats in config.FEATURE_OVERRIDES.items() for f in feats if f not in NUMERIC)


VOCAB = f"""
lv AS ({_levels_sql()})""", """
cnt AS (SELECT segment, feature, level, COUNT(*) AS n FROM lv GROUP BY ALL)""", """
voc AS (
  SELECT segment, feature, level, n, n >= 20 AS frequent,
    SUM(CASE WHEN n >= 20 THEN 1 ELSE 0 END) OVER (PARTITION BY segment, feature ORDER BY level ROWS UNBOUNDED PRECEDING) AS r,
    SUM(CASE WHEN n >= 20 THEN 1 ELSE 0 END) OVER (PARTITION BY segment, feature) AS nf,
    SUM(CASE WHEN n < 20 THEN 1 ELSE 0 END) OVER (PARTITION BY segment, feature) AS ni
  FROM cnt
)""", """
vocab AS (
  SELECT segment, feature, level, n, frequent, CAST(CASE WHEN frequent THEN r - 1 ELSE nf END AS INTEGER) AS slot,
         CAST(nf + CASE WHEN ni > 0 THEN 1 ELSE 0 END AS INTEGER) AS n_slots FROM voc
)"""


@register("cat_vocab_fit", psql("SELECT * FROM vocab", *VOCAB))
def q_cat_vocab_fit(spark, sf_dir):
    """Levels per segment and categorical (NULL → MISSING) with slots; levels seen < 20 times share one slot."""
    def build(seg):
        df, num, cat = _segment(spark, sf_dir, seg)
        return P.fit_vocabulary(P.prep_features(df, num, cat), cat)
    return _each_segment(build)


ENCODE_SQL = f"""SELECT e.event_timestamp, e.user_pseudo_id, u.feature,
  CASE WHEN v.slot IS NULL THEN NULL ELSE v.slot END AS slot
FROM base e,
  (SELECT UNNEST([{', '.join(repr(c) for c in _CAT)}]) AS feature) u
  LEFT JOIN vocab v ON v.segment = 'main' AND v.feature = u.feature AND v.level = COALESCE(
    CASE u.feature {' '.join(f"WHEN '{c}' THEN CAST(e.{c} AS VARCHAR)" for c in _CAT)} END, 'MISSING')"""


@register("cat_encode", psql(ENCODE_SQL, *VOCAB))
def q_cat_encode(spark, sf_dir):
    """Encode every daily-shard event with the main-segment vocabulary: slot of its level,
    the shared slot for infrequent levels, NULL (all-zero block) for levels never seen."""
    df, num, cat = _segment(spark, sf_dir, config.MAIN)
    voc = P.Vocabulary.fit(P.prep_features(df, num, cat), cat)
    events = T.event_projection(dag(spark, sf_dir).base)
    ev = P.prep_features(events, [], cat, keep=["purchase_timestamp", "user_pseudo_id"])
    idx = voc.index_columns(ev)
    long = idx.select(F.col("purchase_timestamp").alias("event_timestamp"), "user_pseudo_id",
                      F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}__idx").alias("i"),
                                                   F.lit(voc.sizes[c]).alias("k")) for c in cat])).alias("e"))
    slot = F.when(F.col("e.i") < F.col("e.k"), F.col("e.i").cast("int"))
    return long.select("event_timestamp", "user_pseudo_id", F.col("e.feature").alias("feature"), slot.alias("slot"))


@register("segment_stats", psql("""SELECT segmento, COUNT(*) AS n_rows, ROUND(AVG(y), 6) AS base_rate,
  ROUND(COUNT(*) / (SELECT COUNT(*) FROM loaded), 6) AS share,
  ROUND(250.0 * (COUNT(*) / (SELECT COUNT(*) FROM loaded)), 6) AS seg_daily FROM loaded GROUP BY segmento"""))
def q_segment_stats(spark, sf_dir):
    """Per segment: rows, base rate, share of rows and daily lead volume."""
    s = P.segment_stats(loaded(spark, sf_dir))
    return s.select(config.SEGMENT_COL, "n_rows", *[F.round(c, 6).alias(c) for c in ("base_rate", "share", "seg_daily")])


@register("class_weight", psql("""SELECT segmento, COUNT_IF(y = 1) AS n_pos, COUNT_IF(y = 0) AS n_neg,
  ROUND(COUNT_IF(y = 0) / greatest(COUNT_IF(y = 1), 1), 6) AS pos_weight FROM loaded GROUP BY segmento"""))
def q_class_weight(spark, sf_dir):
    """Per segment: positives, negatives and the positive-class weight neg / max(pos, 1)."""
    w = P.class_weight(loaded(spark, sf_dir), [config.SEGMENT_COL])
    return w.select(config.SEGMENT_COL, "n_pos", "n_neg", F.round("pos_weight", 6).alias("pos_weight"))


@register("sink_stage_parquet", psql("SELECT * FROM loaded WHERE segmento = 'landing'"))
def q_sink_stage_parquet(spark, sf_dir):
    """Write the prepared frame once, partitioned by segment; read one segment back (pruned)."""
    path = scratch_path(spark, "stage")
    write_stage(loaded(spark, sf_dir), path)
    return read_stage(spark, path, config.LANDING)
