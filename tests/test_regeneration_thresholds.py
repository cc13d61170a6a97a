"""Rewrites against thresholds on score, confidence and dimensions."""

import pytest
from guardlake.operators import regeneration
from guardlake.schemas import DIM_COLUMNS

LIMITS = {"overall": {"score": 8.0, "confidence": 0.5}, "safety": {"score": 7.0}, "privacy": 6.0}


def candidates(spark, *rows):
    shape = "k int, iteration int, score double, confidence double, d_safety double, d_privacy double, text string"
    made = spark.createDataFrame([(1, i + 1, *map(lambda x: x if x is None else float(x), r), f"t{i + 1}") for i, r in enumerate(rows)], shape)
    return made.selectExpr("*", *[f"double(9) AS {c}" for c in DIM_COLUMNS if c not in ("d_safety", "d_privacy")])


ROWS = [(9, 0.9, 6, 5), (9.5, 0.4, 8, 8), (9.4, None, 8, None), (8.5, 0.5, 7, None), (10, 1, 10, 10)]


def test_history_goes_on_until_no_threshold_fails(spark):
    out = regeneration.iteration_history(candidates(spark, *ROWS), "k", LIMITS).orderBy("iteration").collect()
    assert [(r.thresholds_met, r.failing_dimensions) for r in out] == [(False, ["safety", "privacy"]), (False, []), (False, []), (True, [])]
    plain = regeneration.iteration_history(candidates(spark, *ROWS), "k", 8.0).collect()
    assert [(r.iteration, r.thresholds_met, r.failing_dimensions) for r in plain] == [(1, True, [])]


def test_best_is_the_first_that_meets_all(spark):
    r = regeneration.select_best(candidates(spark, *ROWS), "k", LIMITS).first()
    assert (r.status, r.iterations_used, r.best_iteration, r.best_text) == ("passed", 4, 4, "t4")
    r = regeneration.select_best(candidates(spark, *ROWS[:3]), "k", LIMITS, max_iterations=3).first()
    assert (r.status, r.best_iteration) == ("max_iterations_reached", 2)
    df = spark.createDataFrame([(1,)], "k int")
    assert regeneration.attach_best(df, candidates(spark, *ROWS), "k", LIMITS, max_iterations=5).first().regenerated == "t4"


def test_only_dimensions_and_names_of_the_callers_own(spark):
    rows = candidates(spark, *ROWS[:2]).selectExpr("*", "map('tone', if(iteration = 1, 9D, 2D)) more")
    out = regeneration.iteration_history(rows, "k", {"privacy": 6.0, "tone": 3.0}, others="more").orderBy("iteration").collect()
    assert [(r.thresholds_met, r.failing_dimensions) for r in out] == [(False, ["privacy"]), (False, ["tone"])]


@pytest.mark.parametrize("limits", [{"overall": {"label": 1}}, {"safety": {"confidence": 0.5}}])
def test_thresholds_that_nothing_holds_are_refused(spark, limits):
    with pytest.raises(ValueError):
        regeneration.select_best(candidates(spark, *ROWS), "k", limits)
