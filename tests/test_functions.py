"""Edge cases of the column expressions (hand-made frames)."""

import math

import pytest
from pyspark.sql import functions as F

from encore.functions import numeric as N
from encore.functions import rowwise as RW
from encore.functions import text as T
from encore.functions.geo import great_circle_miles


def col(spark, values, typ="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def test_snap_thresholds(spark):
    xs = [0.029, 0.03, 0.25, 0.47, 0.471, 0.529, 0.53, 0.75, 1.98, -1.0]
    want = [0.0, 0.03, 0.25, 0.47, 0.5, 0.5, 0.53, 0.75, 2.0, 0.0]
    got = [r[0] for r in col(spark, xs).select(N.snap("x")).collect()]
    assert got == pytest.approx(want)


def test_round_half_even(spark):
    got = [r[0] for r in col(spark, [0.25, 0.75, 1.25]).select(N.round_to_half(F.col("x") * 0)).collect()]
    assert got == [0.0, 0.0, 0.0]
    got = [r[0] for r in col(spark, [0.5, 1.5, 2.5]).select(N.round_half_even("x")).collect()]
    assert got == [0.0, 2.0, 2.0]
    # x*2 rounded half to even, then halved: 0.25 -> 0, 0.75 -> 1, 1.25 -> 1
    got = [r[0] for r in col(spark, [0.25, 0.75, 1.25]).select(N.round_half_even(F.col("x") * 2)).collect()]
    assert got == [0.0, 2.0, 2.0]


def test_poisoned_sum(spark):
    df = spark.createDataFrame([(1, None), (1, 3.0), (2, 3.0)], "k int, v double")
    got = dict(df.groupBy("k").agg(RW.poisoned_sum("v").alias("s")).collect())
    assert got[1] is None and got[2] == 3.0


def test_postcode_rules(spark):
    vals = ["1234", "12345", "12345-6789", "K1A 0A9", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "z string")
    fixed = [r[0] for r in df.select(T.blank_to_null(T.trim_plus4(T.pad_if_length("z", 4)))).collect()]
    assert fixed == ["01234", "12345", "12345", "K1A 0A9", None, None]
    us = [r[0] for r in df.select(T.is_domestic("z")).collect()]
    assert us == [1.0, 1.0, 1.0, 0.0, 1.0, 1.0]


def test_text_defaults(spark):
    df = spark.createDataFrame([("",), ("12",), ("3",), (None,)], "p string")
    got = [r[0] for r in df.select(T.overlong_to(T.blank_to("p", "1"), 1, "1")).collect()]
    assert got == ["1", "1", "3", None]
    got = [r[0] for r in df.select(T.missing_to("p", "No")).collect()]
    assert got == ["No", "12", "3", "No"]
    n = spark.createDataFrame([("\t Mixed Case  ",)], "s string").select(T.normalize("s")).first()[0]
    assert n == "mixed case"


def test_guarded_ratio_and_year(spark):
    df = spark.createDataFrame([(10.0, 0.0, "2001-01-01"), (10.0, 4.0, "")], "n double, d double, f string")
    got = df.select(N.guarded_ratio("n", "d"), N.year_of("f", 2014)).collect()
    assert [tuple(r) for r in got] == [(0.0, 2001.0), (2.5, 2014.0)]
    assert spark.createDataFrame([("n/a",)], "s string").select(N.to_number("s")).first()[0] is None


def test_row_stats(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 2.0, 2.0)], "a double, b double, c double")
    r = df.select(RW.row_mean(["a", "b", "c"]), RW.row_var(["a", "b", "c"]), RW.row_constant(["a", "b", "c"]),
                  RW.count_positive(["a", "b", "c"])).collect()
    assert tuple(r[0]) == (2.0, 1.0, False, 3.0)
    assert tuple(r[1]) == (2.0, 0.0, True, 3.0)


def test_great_circle_matches_reference_formula(spark):
    lat, lon, lat0, lon0 = 37.9, -122.5, 37.7763272, -122.421545
    r = 3963.34
    rad = math.pi / 180
    dot = (math.cos(lat * rad) * math.cos(lon * rad) * math.cos(lat0 * rad) * math.cos(lon0 * rad)
           + math.cos(lat * rad) * math.sin(lon * rad) * math.cos(lat0 * rad) * math.sin(lon0 * rad)
           + math.sin(lat * rad) * math.sin(lat0 * rad))
    want = r * math.acos(dot)
    df = spark.createDataFrame([(lat, lon)], "Lat double, Long double")
    got = df.select(great_circle_miles(F.col("Lat"), F.col("Long"), lat0, lon0)).first()[0]
    assert got == pytest.approx(want, rel=1e-9)
