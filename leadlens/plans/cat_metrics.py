"""Registered queries: distributed rank and the ranking metrics.

Input is the scored frame ``(id, y, score, segmento)`` derived from the events table;
every metric is computed per segment. ``*_ties`` variants round scores to integers so
that heavy ties are exercised.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..operators import rank as R
from ..session import ensure_session
from ..sources import fixtures as fx
from . import oracle as O
from .catalogue import register

G = [config.SEGMENT_COL]


def _scored(spark, sf_dir, ties=False):
    ensure_session(spark)
    return fx.scored_frame(spark, sf_dir, ties)


def _ranked(spark, sf_dir, ties=False):
    return R.rank_by_score(_scored(spark, sf_dir, ties), group=G)


def scored_cte(ties=False) -> str:
    score = "ROUND(value, 0)" if ties else "value"
    return f"""
scored AS (
  SELECT event_id AS id, CASE WHEN event_name = 'purchase' THEN 1 ELSE 0 END AS y,
         CAST({score} AS DOUBLE) AS score,
         CASE WHEN lower(trim(platform)) = 'landing' THEN 'landing' ELSE 'main' END AS segmento
  FROM fx_flat
)"""


RANKED = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY segmento ORDER BY score DESC, id ASC) AS rank,
         COUNT(*) OVER (PARTITION BY segmento) AS n, SUM(y) OVER (PARTITION BY segmento) AS p
  FROM scored
)"""

CURVE = """
dscore AS (SELECT segmento, score, COUNT(*) AS n_s, SUM(y) AS pos_s FROM scored GROUP BY segmento, score)""", """
curve AS (
  SELECT *, SUM(n_s) OVER w AS cum_n, SUM(pos_s) OVER w AS cum_pos,
         SUM(n_s) OVER (PARTITION BY segmento) AS n, SUM(pos_s) OVER (PARTITION BY segmento) AS p,
         row_number() OVER w AS k, COUNT(*) OVER (PARTITION BY segmento) AS kmax
  FROM dscore
  WINDOW w AS (PARTITION BY segmento ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""


def msql(select: str, *extra: str, ties=False) -> str:
    return O.with_ctes(O.FX_FLAT, scored_cte(ties), RANKED, *CURVE, *extra, select=select)


@register("rank_by_score", msql("SELECT id, segmento, score, y, rank FROM ranked"))
def q_rank_by_score(spark, sf_dir):
    """Exact global descending rank per segment (ties by ascending id), no single-partition window."""
    return _ranked(spark, sf_dir).frame.select("id", "segmento", "score", "y", "rank")


@register("rank_by_score_ties", msql("SELECT id, segmento, score, y, rank FROM ranked", ties=True))
def q_rank_by_score_ties(spark, sf_dir):
    """Exact global rank per segment on integer-rounded (heavily tied) scores."""
    return _ranked(spark, sf_dir, True).frame.select("id", "segmento", "score", "y", "rank")


@register("topk_fraction", msql(
    "SELECT id, segmento, score, y, rank FROM ranked WHERE rank <= greatest(round_even(10 / 100 * n, 0), 1)"))
def q_topk_fraction(spark, sf_dir):
    """Top 10 % of each segment by rank (k = max(round(0.1·n), 1))."""
    return R.topk_fraction(_ranked(spark, sf_dir), 10).select("id", "segmento", "score", "y", "rank")


_AP = "SELECT segmento, CASE WHEN MAX(p) > 0 THEN ROUND(SUM(pos_s / p * (cum_pos / cum_n)), 6) END AS average_precision FROM curve GROUP BY segmento"
_AUC = ("SELECT segmento, CASE WHEN MAX(p) > 0 AND MAX(n - p) > 0 THEN ROUND(SUM((n_s - pos_s) * (2 * cum_pos - pos_s)) "
        "/ (2.0 * MAX(p) * MAX(n - p)), 6) END AS roc_auc FROM curve GROUP BY segmento")


def _ap(spark, sf_dir, ties):
    c = R.distinct_score_curve(_scored(spark, sf_dir, ties), group=G)
    return R.average_precision(c).select("segmento", F.round("average_precision", 6).alias("average_precision"))


def _auc(spark, sf_dir, ties):
    c = R.distinct_score_curve(_scored(spark, sf_dir, ties), group=G)
    return R.roc_auc(c).select("segmento", F.round("roc_auc", 6).alias("roc_auc"))


@register("average_precision", msql(_AP))
def q_average_precision(spark, sf_dir):
    """Step-wise average precision per segment over distinct scores (distributed running sums)."""
    return _ap(spark, sf_dir, False)


@register("average_precision_ties", msql(_AP, ties=True))
def q_average_precision_ties(spark, sf_dir):
    """Average precision on integer-rounded (heavily tied) scores."""
    return _ap(spark, sf_dir, True)


@register("roc_auc", msql(_AUC))
def q_roc_auc(spark, sf_dir):
    """Tie-aware ROC AUC per segment (trapezoid over distinct scores)."""
    return _auc(spark, sf_dir, False)


@register("roc_auc_ties", msql(_AUC, ties=True))
def q_roc_auc_ties(spark, sf_dir):
    """ROC AUC on integer-rounded (heavily tied) scores."""
    return _auc(spark, sf_dir, True)

_ROC_CTES = ("""
nb AS (
  SELECT *, cum_n - cum_pos AS fps, cum_pos AS tps,
    lag(cum_n - cum_pos) OVER w2 AS fps_prev, lead(cum_n - cum_pos) OVER w2 AS fps_next,
    lag(cum_pos) OVER w2 AS tps_prev, lead(cum_pos) OVER w2 AS tps_next
  FROM curve WINDOW w2 AS (PARTITION BY segmento ORDER BY k)
)""", """
kept AS (
  SELECT * FROM nb WHERE k = 1 OR k = kmax OR kmax <= 2
     OR (fps_next - 2 * fps + fps_prev) <> 0 OR (tps_next - 2 * tps + tps_prev) <> 0
)""", """
pts AS (
  SELECT segmento, row_number() OVER (PARTITION BY segmento ORDER BY k) AS j, score AS threshold,
         fps / (n - p) AS fpr, tps / p AS tpr FROM kept
  UNION ALL SELECT DISTINCT segmento, 0, 1.0, 0.0, 0.0 FROM curve
)""", """
npts AS (SELECT segmento, COUNT(*) AS l FROM pts GROUP BY segmento)""", """
pick AS (
  SELECT npts.segmento, CASE WHEN i = 199 THEN l - 1 ELSE CAST(floor(i * ((l - 1) / 199.0)) AS BIGINT) END AS j
  FROM npts, range(0, 200) t(i) WHERE l > 200
  UNION ALL SELECT pts.segmento, pts.j FROM pts JOIN npts USING (segmento) WHERE l <= 200
)""")


@register("roc_points", msql("""SELECT DISTINCT p.segmento, p.j AS point, ROUND(p.threshold, 6) AS threshold,
  ROUND(p.fpr, 6) AS fpr, ROUND(p.tpr, 6) AS tpr FROM pts p JOIN pick USING (segmento, j)""", *_ROC_CTES))
def q_roc_points(spark, sf_dir):
    """ROC corner points, (0,0) start with threshold 1.0, down-sampled to ≤ 200 per segment."""
    c = R.distinct_score_curve(_scored(spark, sf_dir), group=G)
    p = R.roc_points(c)
    return p.select("segmento", "point", *[F.round(x, 6).alias(x) for x in ("threshold", "fpr", "tpr")])


def _probs_sql() -> str:
    return "[" + ", ".join(repr(q) for q in R.qcut_probabilities(10)) + "]"


QCUT = f"""
edges AS (
  SELECT segmento, list_sort(list_distinct(quantile_cont(score, {_probs_sql()}))) AS edges
  FROM scored GROUP BY segmento
)""", """
binned AS (
  SELECT s.*, CAST(greatest(len(list_filter(e.edges, lambda x: x < s.score)), 1) - 1 AS INTEGER) AS bin
  FROM scored s JOIN edges e USING (segmento)
)""", """
dlift AS (
  SELECT b.segmento, b.bin + 1 AS decile, AVG(b.y) AS conv, COUNT(*) AS n,
         AVG(b.y) / (SELECT AVG(y) FROM scored s2 WHERE s2.segmento = b.segmento) AS lift
  FROM binned b GROUP BY b.segmento, b.bin
)"""


def _binned(spark, sf_dir, ties=False):
    return R.qcut_bins(R.scored(_scored(spark, sf_dir, ties), G), "score", 10)


@register("qcut_deciles", msql("SELECT id, segmento, bin FROM binned", *QCUT))
def q_qcut_deciles(spark, sf_dir):
    """Decile bin of every row from exact linear quantiles (duplicate edges dropped)."""
    return _binned(spark, sf_dir).select("id", "segmento", "bin")


@register("qcut_deciles_ties", msql("SELECT id, segmento, bin FROM binned", *QCUT, ties=True))
def q_qcut_deciles_ties(spark, sf_dir):
    """Decile bins on tied scores (duplicate edges dropped)."""
    return _binned(spark, sf_dir, True).select("id", "segmento", "bin")


def _dlift(spark, sf_dir):
    return R.decile_lift(_binned(spark, sf_dir), group=G)


@register("decile_lift", msql("SELECT segmento, CAST(decile AS INTEGER) AS decile, ROUND(conv, 6) AS conv, n, ROUND(lift, 6) AS lift FROM dlift", *QCUT))
def q_decile_lift(spark, sf_dir):
    """Per segment and score decile: conversion, rows and lift over the base rate."""
    d = _dlift(spark, sf_dir)
    return d.select("segmento", "decile", F.round("conv", 6).alias("conv"), "n", F.round("lift", 6).alias("lift"))


@register("top_bin_lift", msql("""SELECT segmento, ROUND(arg_max(lift, decile), 6) AS top_bin_lift,
  CAST(MAX(decile) AS INTEGER) AS top_decile FROM dlift GROUP BY segmento""", *QCUT))
def q_top_bin_lift(spark, sf_dir):
    """Lift of the highest score decile per segment."""
    t = R.top_bin_lift(_dlift(spark, sf_dir), G)
    return t.select("segmento", F.round("top_bin_lift", 6).alias("top_bin_lift"), "top_decile")


BANDS = """
bands AS (SELECT * FROM (VALUES ('A', 0, 25), ('B', 25, 50), ('C', 50, 100)) b(grade, lo_pct, up_pct))""", """
band_stats AS (
  SELECT r.segmento, b.grade, b.lo_pct, b.up_pct, MAX(r.n) AS n, MAX(r.p) AS p,
    COUNT_IF(r.rank > round_even(b.lo_pct / 100 * r.n, 0) AND r.rank <= round_even(b.up_pct / 100 * r.n, 0)) AS n_band,
    SUM(CASE WHEN r.rank > round_even(b.lo_pct / 100 * r.n, 0) AND r.rank <= round_even(b.up_pct / 100 * r.n, 0)
             THEN r.y ELSE 0 END) AS pos_band
  FROM ranked r, bands b GROUP BY r.segmento, b.grade, b.lo_pct, b.up_pct
)"""


def _bsql(select, ties=False):
    return msql(select, *BANDS, ties=ties)


_BAND_LIFT = ("SELECT segmento, grade, CASE WHEN n_band > 0 AND p > 0 THEN ROUND((pos_band / n_band) / (p / n), 6) END AS lift "
              "FROM band_stats")


def _band_lift(spark, sf_dir, ties):
    b = R.band_lift(_ranked(spark, sf_dir, ties))
    return b.select("segmento", "grade", F.round("lift", 6).alias("lift"))


@register("band_lift", _bsql(_BAND_LIFT))
def q_band_lift(spark, sf_dir):
    """Lift of the top 0–25 %, 25–50 % and 50–100 % rank slices per segment."""
    return _band_lift(spark, sf_dir, False)


@register("band_lift_ties", _bsql(_BAND_LIFT, ties=True))
def q_band_lift_ties(spark, sf_dir):
    """Band lift on integer-rounded (heavily tied) scores."""
    return _band_lift(spark, sf_dir, True)


@register("grade_table", _bsql("""SELECT segmento,
  CASE WHEN segmento = 'landing' THEN CASE grade WHEN 'A' THEN 'D' WHEN 'B' THEN 'E' ELSE 'F' END ELSE grade END AS grade,
  CAST(lo_pct AS VARCHAR) || '–' || CAST(up_pct AS VARCHAR) || '%' AS banda,
  ROUND(n_band / greatest(n, 1) * 250.0, 6) AS leads_dia,
  ROUND(CASE WHEN n_band > 0 THEN pos_band / n_band END, 6) AS tasa_exito,
  ROUND(CASE WHEN p > 0 AND n_band > 0 THEN (pos_band / n_band) / (p / n) END, 6) AS vs_azar FROM band_stats"""))
def q_grade_table(spark, sf_dir):
    """Per-grade legend with per-segment display letters (main A/B/C, landing D/E/F)."""
    g = R.grade_table(_ranked(spark, sf_dir))
    return g.select("segmento", "grade", "banda", *[F.round(c, 6).alias(c) for c in ("leads_dia", "tasa_exito", "vs_azar")])


_CUTS = ", ".join(f"({c})" for c in config.CAPACITY_CUTS)


@register("capacity_table", msql(f"""SELECT segmento, top_pct,
  ROUND(top_pct / 100 * 250.0, 6) AS leads_dia,
  ROUND(top_pct / 100 * 250.0 * (tp / k), 6) AS conv_dia,
  ROUND(tp / k, 6) AS tasa_exito,
  ROUND(tp / greatest(p, 1), 6) AS pct_capturadas,
  ROUND(CASE WHEN p > 0 THEN (tp / k) / (p / n) ELSE 'nan'::DOUBLE END, 6) AS vs_azar
FROM (
  SELECT r.segmento, c.top_pct, MAX(r.n) AS n, MAX(r.p) AS p,
    COUNT_IF(r.rank <= greatest(round_even(c.top_pct / 100 * r.n, 0), 1)) AS k,
    SUM(CASE WHEN r.rank <= greatest(round_even(c.top_pct / 100 * r.n, 0), 1) THEN r.y ELSE 0 END) AS tp
  FROM ranked r, (VALUES {_CUTS}) c(top_pct) GROUP BY r.segmento, c.top_pct)"""))
def q_capacity_table(spark, sf_dir):
    """Cumulative-gains table at the 11 top-% cuts, 250 leads/day."""
    t = R.capacity_table(_ranked(spark, sf_dir))
    return t.select("segmento", "top_pct", *[F.round(c, 6).alias(c) for c in
                    ("leads_dia", "conv_dia", "tasa_exito", "pct_capturadas", "vs_azar")])


THR = """
thr AS (SELECT segmento, quantile_cont(score, 0.75) AS q_a, quantile_cont(score, 0.5) AS q_b FROM scored GROUP BY segmento)"""


@register("grade_thresholds", msql("""SELECT segmento, grade, ROUND(threshold, 6) AS threshold FROM (
  SELECT segmento, 'A' AS grade, q_a AS threshold FROM thr UNION ALL SELECT segmento, 'B', q_b FROM thr)""", THR))
def q_grade_thresholds(spark, sf_dir):
    """Score cutoffs at the 75th and 50th percentile per segment (exact, interpolated)."""
    thr = R.grade_thresholds(R.scored(_scored(spark, sf_dir), G))
    rows = [(g[0], grade, float(v)) for g, d in thr.items() for grade, v in d.items()]
    df = spark.createDataFrame(rows, "segmento string, grade string, threshold double")
    return df.select("segmento", "grade", F.round("threshold", 6).alias("threshold"))


@register("grade_assign", msql("""SELECT s.id, s.segmento, CASE WHEN s.segmento = 'landing' THEN
  CASE WHEN s.score >= t.q_a THEN 'D' WHEN s.score >= t.q_b THEN 'E' ELSE 'F' END ELSE
  CASE WHEN s.score >= t.q_a THEN 'A' WHEN s.score >= t.q_b THEN 'B' ELSE 'C' END END AS grade
  FROM scored s JOIN thr t USING (segmento)""", THR))
def q_grade_assign(spark, sf_dir):
    """Letter of every row from its segment's fitted cutoffs (inclusive lower edges)."""
    rk = R.scored(_scored(spark, sf_dir), G)
    thr = R.grade_thresholds(rk)
    m = F.create_map(*[x for g, d in thr.items()
                       for x in (F.lit(g[0]), F.create_map(*[y for k, v in d.items() for y in (F.lit(k), F.lit(v))]))])
    per_row = F.try_element_at(m, F.col("segmento"))
    return rk.frame.select("id", "segmento", R.grade_assign(F.col("score"), per_row, F.col("segmento")).alias("grade"))


@register("confusion_at_top", msql("""SELECT s.segmento, CAST(0.1 AS DOUBLE) AS frac, ROUND(MAX(t.q), 6) AS threshold, COUNT(*) AS n_test,
  COUNT_IF(s.score < t.q AND s.y = 0) AS tn, COUNT_IF(s.score >= t.q AND s.y = 0) AS fp,
  COUNT_IF(s.score < t.q AND s.y = 1) AS fn, COUNT_IF(s.score >= t.q AND s.y = 1) AS tp,
  ROUND(CASE WHEN COUNT_IF(s.score >= t.q) > 0 THEN COUNT_IF(s.score >= t.q AND s.y = 1) / COUNT_IF(s.score >= t.q) ELSE 0 END, 6) AS precision,
  ROUND(CASE WHEN SUM(s.y) > 0 THEN COUNT_IF(s.score >= t.q AND s.y = 1) / SUM(s.y) ELSE 0 END, 6) AS recall
  FROM scored s JOIN (SELECT segmento, quantile_cont(score, 0.9) AS q FROM scored GROUP BY segmento) t USING (segmento)
  GROUP BY s.segmento"""))
def q_confusion_at_top(spark, sf_dir):
    """Confusion matrix at the top-10 % score threshold."""
    c = R.confusion_at_top(R.scored(_scored(spark, sf_dir), G))
    return c.select("segmento", "frac", F.round("threshold", 6).alias("threshold"), "n_test", "tn", "fp", "fn", "tp",
                    F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))
