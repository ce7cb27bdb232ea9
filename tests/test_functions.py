"""Expressions on hand-written rows: NULL, NaN, infinities, sentinels, empty and non-ASCII text."""

import math

import pytest
from pyspark.sql import functions as F

from casebook.functions import dates, fixed_values as V, geo, text, values


def column(spark, kind, inputs, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.select(expression(F.col("v")).alias("out"), "i").orderBy("i").select("out").collect()]


def test_normalize_text(spark):
    given = [None, "", "  USA ", "Uk", "São  Paulo", "a  b", "Yunnan\tProv", "café é bar", "\x1fx\x1f"]
    want = [None, "", "united states", "united kingdom", "so paulo", "a b", "yunnan province", "caf  bar", "x"]
    assert column(spark, "string", given, text.normalize_text) == want


def test_normalize_text_comma(spark):
    given = [None, "", "Madison, WI", "uk, x", " , y"]
    assert column(spark, "string", given, text.normalize_text_comma) == [
        "unknown", "unknown", "madison", "united kingdom", "",
    ]


def test_clean_summary(spark):
    given = [None, "Govt forces bombed. No group claimed responsibility", "x" * 600]
    out = column(spark, "string", given, text.clean_summary)
    assert out[0] == ""
    assert out[1] == "government forces bombing. "
    assert len(out[2]) == 500


def test_motive_patterns_match_whole_words(spark):
    given = ["Holy war", "separatist", "state power", "gang", " Not Known ", "other"]
    assert column(spark, "string", given, text.motive_class) == [
        "religious", "separatist", "anti-government", "criminal", "unknown", "other",
    ]


def test_group_in_text_checks_names_after_first_phrase(spark):
    find = lambda c: text.first_phrase(c, V.GROUP_ALIASES, V.GROUP_NAMES_IN_TEXT)
    given = ["the Taliban and al-qaida", "boko haram isis", "boko haram only", "nothing", None]
    assert column(spark, "string", given, find) == ["taliban", "islamic state", "boko haram", None, None]


def test_other_year(spark):
    df = spark.createDataFrame([("in 1999", 1999), ("in 1999", 2001), ("1969", 2000), (None, 2000)], "s string, y int")
    flags = df.select(text.mentions_other_year(F.col("s"), F.col("y")).cast("int").alias("f")).collect()
    assert [r.f for r in flags] == [0, 1, 0, 0]


def test_usable_label(spark):
    out = column(spark, "string", [None, " ", "NaN", "x"], text.usable_label)
    assert [bool(x) for x in out] == [False, False, False, True]


def test_whole_number_guards(spark):
    given = [None, float("nan"), float("inf"), float("-inf"), 2.9, -2.9]
    assert column(spark, "double", given, values.whole_number) == [0, 0, 0, 0, 2, -2]


def test_clip_keeps_null(spark):
    assert column(spark, "double", [None, -5.0, 0.5, 9.0], lambda c: values.clip(c, 0, 1)) == [None, 0.0, 0.5, 1.0]


def test_value_category_and_bins(spark):
    given = [None, -1.0, 0.0, 1.0, 1000.0, 1000.5, 1e6, 1e9, 2e9]
    assert column(spark, "double", given, values.value_category) == [
        "None", "None", "None", "Low", "Low", "Medium", "Medium", "High", "Catastrophic",
    ]
    bins = column(spark, "double", given, values.bin_label)
    assert bins[:3] == [None, None, "[0, 1000]"] and bins[5] == "(1000, 1000000]" and bins[-1] == "(1000000000, inf]"


def test_non_numeric(spark):
    out = column(spark, "string", [None, "1.5", "n/a", "1e3"], values.is_not_numeric)
    assert out == [False, False, True, False]


def test_calendar(spark):
    rows = [(2000, 2, 29), (1900, 2, 29), (2001, 2, 29), (2000, 4, 31), (2000, 13, 1), (2000, 0, 1), (None, 1, 1)]
    df = spark.createDataFrame(rows, "y int, m int, d int")
    parts = (F.col("y"), F.col("m"), F.col("d"))
    out = df.select(dates.is_calendar_date(*parts).alias("ok"), dates.date_of(*parts).alias("date")).collect()
    assert [r.ok for r in out] == [True, False, False, False, False, False, True]
    assert out[1].date is None and str(out[0].date) == "2000-02-29"


def test_grain_is_checked():
    with pytest.raises(ValueError):
        dates.truncated(F.lit(None), "Week")


def test_distance(spark):
    points = [(0.0, 0.0, 0.0, 0.0), (0.0, 0.0, 0.0, 1.0), (0.0, 0.0, 90.0, 0.0), (48.8566, 2.3522, 40.7128, -74.0060)]
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    km = [r[0] for r in df.select(geo.ellipsoid_km(*[F.col(c) for c in "abcd"])).collect()]
    # Known ellipsoid distances: a degree of the equator, a quarter meridian, Paris to New York.
    for got, want in zip(km, [0.0, 111.3195, 10001.966, 5852.935]):
        assert math.isclose(got, want, rel_tol=2e-5, abs_tol=1e-9)
