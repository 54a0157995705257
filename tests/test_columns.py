"""One test per column rule, on hand-made edge rows."""

import math

import pytest
from pyspark.sql import functions as F

from haulyard.functions import columns as C
from haulyard.functions.geo import nearest_city


def values(spark, rows, schema, expression):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


def test_number_coerces_and_drops_nan(spark):
    got = values(spark, [("1.5",), ("abc",), ("NaN",), (None,), ("",)], "x string", C.number("x"))
    assert got == [1.5, None, None, None, None]


def test_flag_of_null_is_zero(spark):
    assert values(spark, [(1,), (2,), (None,)], "x int", C.flag(F.col("x") == 1)) == [1, 0, 0]


def test_violation_counts_null(spark):
    got = values(spark, [("A",), ("Z",), (None,)], "x string", C.violates(F.col("x").isin("A", "B")))
    assert got == [False, True, True]


def test_clip_keeps_null(spark):
    assert values(spark, [(-5.0,), (50.0,), (500.0,), (None,)], "x double", C.clip("x", 0, 100)) == [0, 50, 100, None]


def test_cut_is_right_closed(spark):
    rows = [(-1.0,), (0.0,), (0.5,), (30.0,), (30.1,), (90.0,), (200.0,), (200.1,), (None,)]
    got = values(spark, rows, "x double", C.cut("x", [-1, 0, 30, 60, 90, 200], ["S", "L", "M", "F", "O"]))
    assert got == ["nan", "S", "L", "L", "M", "F", "O", "nan", "nan"]


def test_rounding_scales_and_rounds_half_to_even(spark):
    numbers = [0.125, 0.375, 1.005, 2.675, -0.125, 1234.565]
    got = values(spark, [(n,) for n in numbers], "x double", C.rounded("x", 2))
    assert got == [round(n * 100) / 100 if not (n * 100 % 1 == 0.5) else 2 * round(n * 50) / 100 for n in numbers]


def test_half_up_differs_from_even(spark):
    assert values(spark, [(0.125,), (2.675,)], "x double", C.half_up("x", 2)) == [0.13, 2.68]


def test_title_case_follows_non_letters(spark):
    texts = ["l&t goods", "FMCG GOODS", "o'neil-smith", "4x4 truck", "nation_1", "nation_a", "(abc) d.e", "  pad ", "", "a\tb", "élan Été"]
    got = values(spark, [(t,) for t in [*texts, None]], "x string", C.title_case("x"))
    assert got == [*[t.title() for t in texts], None]


def test_ratio_and_share_of_nothing(spark):
    rows = [(1.0, 0.0), (1.0, 4.0)]
    assert values(spark, rows, "a double, b double", C.ratio(F.col("a"), F.col("b"))) == [None, 0.25]
    assert values(spark, rows, "a double, b double", C.share_pct(F.col("a"), F.col("b"))) == [0.0, 25.0]


def test_truthy(spark):
    rows = [("True",), ("true",), ("1",), ("False",), ("yes",), (None,)]
    assert values(spark, rows, "x string", C.truthy("x")) == [True, True, True, False, False, False]
    assert values(spark, [(True,), (False,), (None,)], "x boolean", C.truthy("x")) == [True, False, False]


def test_timestamps_lenient_and_strict(spark):
    frame = spark.createDataFrame([("2026-04-07T06:00:00+05:30",), ("junk",)], "t string")
    got = frame.select(C.as_timestamp(frame, "t").cast("string")).collect()
    assert [r[0] for r in got] == ["2026-04-07 00:30:00", None]
    with pytest.raises(Exception):
        frame.select(C.as_timestamp(frame, "t", strict=True)).collect()


def test_night_shift(spark):
    got = values(spark, [(h,) for h in (5, 6, 19, 20, None)], "h int", C.night_shift(F.col("h")))
    assert got == [1, 0, 0, 1, 0]


def test_nearest_city_ties_and_gaps(spark):
    points = [("First", 0.0, 0.0), ("Second", 0.0, 2.0), ("Third", 5.0, 5.0)]
    rows = [(0.0, 1.0), (0.0, 1.5), (4.0, 5.0), (None, 1.0), (1.0, None)]
    got = values(spark, rows, "a double, b double", nearest_city(F.col("a"), F.col("b"), points))
    assert got == ["First", "Second", "Third", "First", "First"]


def test_no_python_in_nearest_city(spark, data):
    from haulyard import bindings
    from haulyard.plans import enrich

    plan = enrich.with_nearest_city(bindings.iot(spark, data))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan


def test_rounding_of_missing(spark):
    assert values(spark, [(None,)], "x double", C.rounded("x", 2)) == [None]
    assert math.isclose(values(spark, [(2.5,)], "x double", C.rounded("x", 0))[0], 2.0)
