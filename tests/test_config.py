"""Routing, letters and gate constants (the contract of the reference's config tests)."""
from pyspark.sql import functions as F

from leadlens import config
from leadlens.functions.text import route_segment
from leadlens.operators.rank import grade_assign


def _route(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "platform string")
    return [r[0] for r in df.select(route_segment(F.col("platform"))).collect()]


def test_route_landing_normalised(spark):
    assert _route(spark, ["landing", "  LANDING ", "\tLanding\n", "　landing"]) == ["landing"] * 4


def test_route_everything_else_is_main(spark):
    assert _route(spark, ["main_site", "anything_else", None, "  ", ""]) == ["main"] * 5


def test_route_absent_platform_column(spark):
    df = spark.createDataFrame([("x",)], "form_name string")
    assert df.select(route_segment(None)).collect()[0][0] == "main"


def _grades(spark, scores, thr, seg):
    df = spark.createDataFrame([(float(s), seg) for s in scores], "score double, seg string")
    return [r[0] for r in df.select(grade_assign(F.col("score"), thr, F.col("seg"))).collect()]


def test_letters_follow_the_segment_of_the_row(spark):
    cuts = {"A": 0.305, "B": 0.125}
    around = [1.0, 0.305, 0.3049, 0.2, 0.125, 0.1249, 0.0, -3.0]
    assert "".join(_grades(spark, around, cuts, "main")) == "AABBBCCC"
    assert "".join(_grades(spark, around, cuts, "landing")) == "DDEEEFFF"
    assert "".join(_grades(spark, around, cuts, None)) == "AABBBCCC"


def test_no_letters_without_cutoffs(spark):
    for none in (None, {}):
        assert _grades(spark, [0.9, 0.0], none, "landing") == [None, None]


def test_equal_cutoffs_leave_no_middle_letter(spark):
    assert _grades(spark, [0.51, 0.5, 0.49], {"A": 0.5, "B": 0.5}, "main") == ["A", "A", "C"]


def test_bands_cover_all_ranks():
    uppers, letters = config.band_uppers(), config.canonical_grades()
    assert len(uppers) == len(letters) and uppers[-1] == 100 and uppers == sorted(set(uppers))
    assert all(len(set(v)) == len(letters) for v in config.GRADE_LETTERS.values())
    assert set(config.GRADE_LETTERS) == set(config.SEGMENTS) == set(config.FEATURE_OVERRIDES)


def test_gate_and_columns():
    assert config.PROMOTION["metric"] == f"lift_{letters_first()}" and config.PROMOTION["max_regression"] < config.PROMOTION["min_abs"]
    assert config.TARGET != config.RAW_TARGET and config.TARGET not in config.ID_COLS
    assert not {config.TARGET, config.RAW_TARGET, *config.ID_COLS} & {c for f in config.FEATURE_OVERRIDES.values() for c in f} - {"product_id"}


def letters_first() -> str:
    return config.canonical_grades()[0]
