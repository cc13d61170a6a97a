"""Literal-row tests of bands, names, weights and dimension functions."""

import pytest
from pyspark.sql import functions as F

from guardlake import functions as C
from guardlake.schemas import DIM_COLUMNS


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize(
    "fn,cases",
    [
        (C.score_label, {10.0: "Excellent", 8.0: "Excellent", 7.9: "Good", 6.0: "Good", 5.9: "Fair", 4.0: "Fair", 3.9: "Poor", 2.0: "Poor", 1.9: "Critical", 0.0: "Critical"}),
        (C.score_color, {7.0: "green", 6.9: "yellow", 5.0: "yellow", 4.9: "red"}),
        (C.score_grade, {9.0: "A", 8.9: "A-", 8.0: "A-", 7.9: "B", 7.0: "B", 6.9: "C", 6.0: "C", 5.9: "D", 5.0: "D", 4.9: "F"}),
        (C.risk_band, {7.0: "low", 6.9: "medium", 5.0: "medium", 4.9: "high", 3.0: "high", 2.9: "critical"}),
        (C.is_passing, {7.0: True, 6.9: False}),
    ],
)
def test_bands(spark, fn, cases):
    assert values(spark, fn("s"), [(s,) for s in cases], "s double") == list(cases.values())


def test_text_functions(spark):
    assert values(spark, C.format_score("s"), [(8.567,), (9.0,)], "s double") == ["8.6", "9.0"]
    assert values(spark, C.format_score("s", 2), [(8.567,)], "s double") == ["8.57"]
    exact = [(8.575,), (1.005,), (8.345,), (2.675,), (-1.125,), (0.0,), (-0.004,), (10.0,), (0.125,)]
    assert values(spark, C.format_score("s", 2), exact, "s double") == ["8.57", "1.00", "8.35", "2.67", "-1.13", "0.00", "-0.00", "10.00", "0.13"]
    assert values(spark, C.format_score("s"), [(1.45,), (8.25,), (0.25,), (9.95,), (99.95,)], "s double") == ["1.4", "8.3", "0.3", "9.9", "100.0"]
    assert values(spark, C.format_score("s", 0), [(2.5,), (0.5,), (1.4999999999999998,)], "s double") == ["3", "1", "1"]


def test_fixed_decimals_are_exact(spark):
    from decimal import ROUND_HALF_UP, Decimal
    from random import Random

    rng = Random(5)
    numbers = [rng.choice([rng.uniform(0, 10), rng.randrange(10_001) / 1000, rng.randrange(800) / 64, rng.uniform(0, 1e9)]) for _ in range(4000)]
    for d in (0, 1, 2, 3):
        got = values(spark, C.format_score("s", d), [(x,) for x in numbers], "s double")
        assert got == [str(Decimal(x).quantize(Decimal(1).scaleb(-d), ROUND_HALF_UP)) for x in numbers]


def test_dimensions_of_the_callers_own(spark):
    df = spark.createDataFrame([(9.0, {"tone": 3.0, "depth": 8.0}), (2.0, None)], "d_safety double, more map<string,double>")
    df = df.select(*[F.lit(None).cast("double").alias(c) for c in DIM_COLUMNS if c != "d_safety"], "d_safety", "more")
    limits = {"tone": 5.0, "safety": 4.0, "absent": 9.0}
    assert [r[0] for r in df.select(C.failed_dimensions(limits, others="more")).collect()] == [["tone"], ["safety"]]
    with pytest.raises(ValueError):
        C.failed_dimensions(limits)
    assert [r[0] for r in df.select(C.weighted_score({"tone": 0.5, "safety": 0.5}, others="more")).collect()] == [6.0, 1.0]
    assert [round(r[0], 9) for r in df.select(C.weighted_score(others="more")).collect()] == [round(20 / 3, 9), 2.0]
    names = [("user_impact",), ("safety",), ("aBC_dEF",), ("",)]
    assert values(spark, C.format_dimension_name("s"), names, "s string") == ["User Impact", "Safety", "ABC DEF", ""]
    assert values(spark, C.normalize_dimension("s"), [("legal_compliance",), ("safety",)], "s string") == ["inclusivity", "safety"]
    aliases = {"ai_act": "eu_ai_act", "euaia": "eu_ai_act", "dpdp": "india_dpdp", "ai_governance": "india_ai_gov", "india_ai": "india_ai_gov", "gdpr": "gdpr", "other": "other"}
    assert values(spark, C.resolve_framework("s"), [(a,) for a in aliases], "s string") == list(aliases.values())
    assert values(spark, C.preview("s", 3, ellipsis=True), [("abc",), ("abcd",)], "s string") == ["abc", "abc…"]
    assert values(spark, C.severity_level("s"), [("low",), ("medium",), ("high",), ("critical",)], "s string") == ["WARN", "WARN", "ERROR", None]


def test_blank_knows_unicode_spaces(spark):
    rows = [("",), (" \t\n",), (" ",), ("﻿　",), ("​",), ("a",), (None,)]
    assert values(spark, C.is_blank("s"), rows, "s string") == [True, True, True, True, False, False, True]


def test_weights(spark):
    rows = [({"a": 50.0, "b": 50.0},), ({"a": 33.3, "b": 33.3, "c": 33.4},), ({"a": 60.0, "b": 50.0},), ({"a": 50.0, "b": 49.0},), ({"a": 0.0, "b": 0.0},)]
    schema = "w map<string,double>"
    assert values(spark, C.weights_sum_ok("w"), rows, schema) == [True, True, False, True, False]
    assert values(spark, C.weights_sum_ok("w", strict=True), rows, schema) == [True, True, False, False, False]
    assert values(spark, C.normalize_weights("w"), [({"a": 1.0, "b": 3.0},), ({"a": 0.0},)], schema) == [{"a": 0.25, "b": 0.75}, None]
    got = values(spark, C.normalize_weights_100("w"), [({"a": 0.6, "b": 0.4},), ({"a": 60.0, "b": 40.0},), ({"a": 3.0},)], schema)
    assert got == [{"a": 60.0, "b": 40.0}, {"a": 60.0, "b": 40.0}, {"a": 3.0}]


def dims(spark, **scores):
    row = {c: float(scores[c[2:]]) if c[2:] in scores else None for c in DIM_COLUMNS}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} double" for c in row))


def test_dimension_functions(spark):
    df = dims(spark, safety=9.0, privacy=6.5, fairness=6.0, transparency=7.8)
    row = df.select(
        C.lowest_dimension().alias("low"),
        C.highest_dimension().alias("high"),
        C.dimensions_below(7.0).alias("b7"),
        C.dimensions_below(8.0).alias("b8"),
        C.dimensions_below(5.0).alias("b5"),
        C.failed_dimensions({"transparency": 8.0, "privacy": 7.0, "user_impact": 9.0, "safety": 9.0}).alias("failed"),
        C.weighted_score().alias("equal"),
        C.weighted_score({"safety": 0.5, "privacy": 0.5}).alias("two"),
        C.weighted_score({"safety": 50, "privacy": 50}).alias("percent"),
    ).first()
    assert (row.low.dimension, row.low.score) == ("fairness", 6.0)
    assert (row.high.dimension, row.high.score) == ("safety", 9.0)
    assert [e.dimension for e in row.b7] == ["fairness", "privacy"]
    assert [e.dimension for e in row.b8] == ["fairness", "privacy", "transparency"]
    assert row.b5 == []
    assert row.failed == ["transparency", "privacy"]
    assert row.equal == pytest.approx(7.325)
    assert row.two == pytest.approx(7.75)
    assert row.percent == pytest.approx(775.0)


def test_ties_go_to_the_first_dimension(spark):
    row = dims(spark, privacy=5.0, fairness=5.0, reliability=5.0).select(
        C.lowest_dimension().alias("low"), C.highest_dimension().alias("high")
    ).first()
    assert (row.low.dimension, row.high.dimension) == ("privacy", "privacy")


def test_no_scored_dimension(spark):
    row = dims(spark).select(
        C.lowest_dimension().alias("low"), C.weighted_score().alias("w"), C.failed_dimensions({"safety": 7.0}).alias("f")
    ).first()
    assert row.low.dimension is None and row.w == 0.0 and row.f == []


def test_restrict_and_per_row_minimums(spark):
    df = dims(spark, safety=3.0, privacy=4.0)
    only = C.restrict_dimensions(df, ["privacy"]).first()
    assert only.d_safety is None and only.d_privacy == 4.0
    minimums = F.array(
        F.struct(F.lit("privacy").alias("dim"), F.lit(5.0).alias("min")),
        F.struct(F.lit("fairness").alias("dim"), F.lit(5.0).alias("min")),
        F.struct(F.lit("safety").alias("dim"), F.lit(3.0).alias("min")),
    )
    assert df.select(C.failed_dimensions_by(minimums).alias("f")).first().f == ["privacy"]
