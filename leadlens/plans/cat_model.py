"""Registered queries: splits, search, fits, stability, registry, gate, scoring.

Search, fits and stability run at the reference's sizes (60 draws x 4 folds x 400 rounds, at most 2000 rounds with a
patience of 50, 5 seeds). A trained run is memoised per (application, sf_dir) so the registry/scoring queries share it.
The learner itself is held against SQL by a fit of fixed parameters (``boosted_trees``, ``boosted_scores``).
"""
from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from .. import config
from ..operators import model as M
from ..operators import prepare as P
from ..operators import rank as R
from ..operators import registry as RG
from ..operators.boosting import NODES
from ..operators.split import stratified_folds, stratified_split
from ..session import scratch_path
from ..sources import fixtures as fx
from .cat_prepare import loaded, psql
from . import boost_sql as BS
from . import oracle as O
from .catalogue import register
from .training_run import train_segments

BUDGET = M.TrainBudget()
_RUNS: dict = {}
_TABLES: dict = {}
RUN_TIME, OPERATOR_TIME = dt.datetime(2024, 1, 31), dt.datetime(2024, 1, 31, 12)


def operator_registry(spark, res):
    """The run's registry after an operator has made the newest candidates live, whatever the gate decided."""
    reg = RG.read_registry(spark, res.registry_path)
    return reg.unionByName(RG.manual_promote(reg, OPERATOR_TIME))


def trained(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        root = scratch_path(spark, "models")
        _TABLES[key] = loaded_table(spark, sf_dir)  # stored once, read again by the queries that score the rows of the run
        res = train_segments(spark, _TABLES[key], f"{root}/bundles", f"{root}/registry", BUDGET,
                             now=RUN_TIME)
        _RUNS[key] = res
    return _RUNS[key]


def run_rows(spark, sf_dir):
    """The training table of the trained run, as the trainer reads it."""
    trained(spark, sf_dir)
    return P.load_training_frame(_TABLES[spark.sparkContext.applicationId, sf_dir])


def loaded_table(spark, sf_dir):
    from .cat_training import dag
    return dag(spark, sf_dir).table


SPLIT_SQL = """
keys AS (SELECT ld_mcs_id, max(y) AS y FROM loaded GROUP BY ld_mcs_id)""", """
ranked_keys AS (
  SELECT *, row_number() OVER (PARTITION BY y ORDER BY sha256('{seed}:' || ld_mcs_id), ld_mcs_id) AS r,
         COUNT(*) OVER (PARTITION BY y) AS n FROM keys
)"""


@register("stratified_split", psql("""SELECT l.ld_mcs_id, l.y, CASE WHEN r <= n - held THEN 'train'
  WHEN r <= n - CAST(ceil(CAST(2 AS DOUBLE) / 3 * held) AS BIGINT) THEN 'eval' ELSE 'test' END AS split
FROM loaded l JOIN (SELECT *, CAST(ceil(CAST(0.3 AS DOUBLE) * n) AS BIGINT) AS held FROM ranked_keys) k
  ON k.ld_mcs_id = l.ld_mcs_id""",
      SPLIT_SQL[0], SPLIT_SQL[1].format(seed=0)))
def q_stratified_split(spark, sf_dir):
    """Seeded 70/10/20 split of leads, exact per-class shares (seed 0)."""
    return stratified_split(loaded(spark, sf_dir), 0).select("ld_mcs_id", config.TARGET, "split")


@register("stratified_kfold", psql("SELECT l.ld_mcs_id, l.y, CAST((r - 1) % 4 AS INTEGER) AS fold FROM loaded l JOIN ranked_keys k ON k.ld_mcs_id = l.ld_mcs_id",
                                   SPLIT_SQL[0], SPLIT_SQL[1].format(seed=1_000_003)))
def q_stratified_kfold(spark, sf_dir):
    """Four seeded, class-balanced folds of leads (seed 0)."""
    return stratified_folds(loaded(spark, sf_dir), 0, 4).select("ld_mcs_id", config.TARGET, "fold")


def _main(spark, sf_dir):
    df = P.segment_frame(loaded(spark, sf_dir), config.MAIN)
    return df, M.feature_spec(df, config.FEATURE_OVERRIDES[config.MAIN])


@register("random_search")
def q_random_search(spark, sf_dir):
    """Seeded random search with k-fold CV on the main segment: one row a draw, and what the chosen one gives refitted."""
    df, spec = _main(spark, sf_dir)
    res = M.tune_segment(df, spec, BUDGET)
    rows = [(config.MAIN, i, json.dumps(p, sort_keys=True), res.cv[i], p == res.params,
             res.best_iteration if p == res.params else None,
             json.dumps(res.test_metrics, sort_keys=True) if p == res.params else None)
            for i, p in enumerate(M.sample_params(BUDGET.n_iter, BUDGET.seed))]
    return spark.createDataFrame(rows, "segment string, draw int, params string, cv_pr_auc double, chosen boolean, "
                                       "best_iteration int, test_metrics string")


@register("fit_early_stop")
def q_fit_early_stop(spark, sf_dir):
    """Fit on train with the eval split as validation: the evaluation of every round that was grown."""
    df, spec = _main(spark, sf_dir)
    sp = stratified_split(df, 42)
    train = sp.filter(F.col("split") == "train")
    vocab = P.Vocabulary.fit(P.prep_features(train, spec.num, spec.cat), spec.cat)
    params = M.sample_params(1, 42)[0]
    model, iters = M.fit_early_stop(sp, spec, vocab, params, BUDGET, M.pos_weight_of(train), "ld_mcs_id")
    rows = [(config.MAIN, i, float(v), i == model.best, iters) for i, v in enumerate(model.history)]
    return spark.createDataFrame(rows, "segment string, round int, eval_pr_auc double, best boolean, best_iteration int")


#: A fit that SQL can restate: no sampling, two levels a tree, the least number of production rounds.
FIXED = {"max_depth": 2, "learning_rate": 0.3, "reg_lambda": 1.5, "reg_alpha": 0.25, "min_child_weight": 2, "gamma": 0.5}
BOOST_CTES = [*BS.encoded(config.FEATURE_OVERRIDES, {"ga_session_number"}), *BS.fitted(FIXED, config.MIN_ROUNDS)]


def _fixed_bundles(spark, sf_dir):
    df = P.load_training_frame(loaded_table(spark, sf_dir))
    parts = {seg: P.segment_frame(df, seg) for seg in config.SEGMENTS}
    return {seg: M.fit_production(p, seg, M.feature_spec(p, config.FEATURE_OVERRIDES[seg]), FIXED, 1) for seg, p in parts.items()}


@register("boosted_trees", psql(BS.trees_select(config.MIN_ROUNDS), *BOOST_CTES))
def q_boosted_trees(spark, sf_dir):
    """Every node of the models that fixed parameters give on 100 % of each segment."""
    rows = [(seg, *r) for seg, b in _fixed_bundles(spark, sf_dir).items() for r in b.model.table()]
    out = spark.createDataFrame(rows, f"segment string, {NODES}")
    return out.withColumns({c: F.round(c, 9) for c in ("gain", "cover", "value")})


@register("boosted_scores", psql(BS.scores_select(config.MIN_ROUNDS), *BOOST_CTES))
def q_boosted_scores(spark, sf_dir):
    """Batch scores of all leads by those models, in one scan."""
    out = M.score_batch(loaded(spark, sf_dir), _fixed_bundles(spark, sf_dir), ["ld_mcs_id"])
    return out.select("ld_mcs_id", config.SEGMENT_COL, "model_segment", F.round("score", 9).alias("score"))


def _meta_frame(spark, sf_dir, keys):
    res = trained(spark, sf_dir)
    rows = [(seg, *[json.dumps(b.meta.get(k), default=str) if isinstance(b.meta.get(k), (dict, list)) else str(b.meta.get(k))
                    for k in keys]) for seg, b in res.candidates.items()]
    return spark.createDataFrame(rows, ", ".join(["segment string"] + [f"{k} string" for k in keys]))


@register("fit_production")
def q_fit_production(spark, sf_dir):
    """Production bundle per segment: rounds = max(median best iteration, 10), base rate, rows."""
    return _meta_frame(spark, sf_dir, ["n_estimators", "base_rate", "n_train", "params", "grade_thresholds"])


@register("multi_seed_stability")
def q_multi_seed_stability(spark, sf_dir):
    """Mean and population std of AP, ROC AUC and band lifts over seeded refits."""
    res = trained(spark, sf_dir)
    rows = []
    for seg, b in res.candidates.items():
        for metric, v in b.meta["metrics"].items():
            if isinstance(v, dict):
                rows.append((seg, metric, float(v["mean"]), float(v["std"])))
    return spark.createDataFrame(rows, "segment string, metric string, mean double, std double")


@register("sink_model_registry")
def q_sink_model_registry(spark, sf_dir):
    """Candidate rows written to the registry table (bundle path, gate metric, metadata)."""
    res = trained(spark, sf_dir)
    reg = RG.read_registry(spark, res.registry_path)
    return reg.filter(F.col("stage") == "candidate").select("segment", "stage", "version", "metric", "metric_value")


@register("promote_live")
def q_promote_live(spark, sf_dir):
    """Gate decisions of the run and the live rows appended for promoted segments."""
    res = trained(spark, sf_dir)
    reg = RG.read_registry(spark, res.registry_path)
    live = reg.filter(F.col("stage") == "live").select("segment", F.col("version").alias("live_version"))
    return res.decisions.select("segment", "promoted", "reason_code", "candidate", "live").join(live, "segment", "left")


@register("src_live_models")
def q_src_live_models(spark, sf_dir):
    """Live bundle per segment loaded from the registry (a failing segment is skipped)."""
    res = trained(spark, sf_dir)
    bundles, versions = RG.load_live_models(spark, operator_registry(spark, res))
    rows = [(seg, versions[seg], len(b.spec.features), sum(b.vocab.sizes.values())) for seg, b in bundles.items()]
    return spark.createDataFrame(rows, "segment string, version string, n_features int, n_slots int")


@register("score_batch")
def q_score_batch(spark, sf_dir):
    """Score every lead of the training table with its routed segment's live model."""
    res = trained(spark, sf_dir)
    bundles, _ = RG.load_live_models(spark, operator_registry(spark, res))
    return M.score_batch(loaded(spark, sf_dir), bundles, ["ld_mcs_id"])


FP_SQL = """SELECT COUNT(*) AS n_rows, sha256(CAST(COUNT(*) AS VARCHAR) || ':' || CAST(COALESCE(SUM(
  CAST(('0x' || substr(sha256(COALESCE('=' || ld_mcs_id, '~') || '|' || COALESCE('=' || CAST(y AS VARCHAR), '~')), 1, 15)) AS BIGINT)), 0) AS VARCHAR)) AS data_hash
FROM loaded"""


@register("data_fingerprint", psql(FP_SQL))
def q_data_fingerprint(spark, sf_dir):
    """Order-insensitive, multiset-safe content hash of (lead id, target)."""
    return RG.data_fingerprint(loaded(spark, sf_dir))


@register("provenance_record", psql(f"SELECT 'model_train' AS table_ref, 'fixture' AS data_version, * FROM ({FP_SQL})"))
def q_provenance_record(spark, sf_dir):
    """Table reference, data version, row count and content hash of the training frame."""
    return RG.provenance_record(loaded(spark, sf_dir), "model_train", "fixture")


def _lift_a_sql(name: str, score: str) -> str:
    return f"""
{name}_scored AS (
  SELECT event_id AS id, CASE WHEN event_name = 'purchase' THEN 1 ELSE 0 END AS y, CAST({score} AS DOUBLE) AS score,
         CASE WHEN lower(trim(platform)) = 'landing' THEN 'landing' ELSE 'main' END AS segmento FROM fx_flat
),
{name}_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY segmento ORDER BY score DESC, id) AS rank,
         COUNT(*) OVER (PARTITION BY segmento) AS n, SUM(y) OVER (PARTITION BY segmento) AS p FROM {name}_scored
),
{name}_lift AS (
  SELECT segmento, (SUM(CASE WHEN rank <= round_even(25 / 100 * n, 0) THEN y ELSE 0 END)
                    / COUNT_IF(rank <= round_even(25 / 100 * n, 0))) / (MAX(p) / MAX(n)) AS v
  FROM {name}_ranked GROUP BY segmento
)"""


GATE_SQL = "WITH " + ",\n".join([O.FX_FLAT,
                                  _lift_a_sql("cand", "value"), _lift_a_sql("prev", "ROUND(value, 0)")]) + """
SELECT c.segmento AS segment,
  (c.v IS NOT NULL AND NOT isnan(c.v) AND c.v >= 1.0) AND (l.v IS NULL OR isnan(l.v) OR c.v >= l.v - CAST(0.15 AS DOUBLE)) AS promoted,
  CASE WHEN NOT (c.v IS NOT NULL AND NOT isnan(c.v) AND c.v >= 1.0) THEN 'below_min'
       WHEN l.v IS NULL OR isnan(l.v) THEN 'bootstrap'
       WHEN c.v >= l.v - CAST(0.15 AS DOUBLE) THEN 'no_regression' ELSE 'regression' END AS reason_code,
  ROUND(c.v, 6) AS candidate, ROUND(CASE WHEN l.v IS NULL OR isnan(l.v) THEN -1.0 ELSE l.v END, 6) AS live
FROM cand_lift c LEFT JOIN (SELECT * FROM prev_lift WHERE segmento = 'main') l USING (segmento)"""


@register("promotion_gate", GATE_SQL)
def q_promotion_gate(spark, sf_dir):
    """Gate per segment: candidate = top-25 % lift of the value score; the live metric is the
    rounded-score lift, registered for ``main`` only (``landing`` bootstraps)."""
    def lift_a(ties):
        rk = R.rank_by_score(fx.scored_frame(spark, sf_dir, ties), group=[config.SEGMENT_COL])
        return (R.band_lift(rk).filter(F.col("grade") == "A")
                .select(F.col(config.SEGMENT_COL).alias("segment"), F.col("lift").alias("metric_value")))
    cand = lift_a(False)
    live = lift_a(True).filter(F.col("segment") == config.MAIN)
    g = RG.promotion_gate(cand, live)
    return g.select("segment", "promoted", "reason_code", F.round("candidate", 6).alias("candidate"),
                    F.round("live", 6).alias("live"))


@register("evaluate_report")
def q_evaluate_report(spark, sf_dir):
    """Held-out evaluation of each segment's search winner: decile lift table."""
    res = trained(spark, sf_dir)
    out = None
    for seg, rep in res.reports.items():
        d = rep["decile_lift"].withColumn("segment", F.lit(seg))
        out = d if out is None else out.unionByName(d)
    return out
