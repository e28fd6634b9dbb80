"""Text coercion against a plain-Python reading of the same rules."""

import re
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanmill.functions import numbers as N
from loanmill.functions import text as X

NUMBER = re.compile(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?")
STAMP = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?")


def number(text):
    if text is None:
        return None
    text = text.replace(",", "").replace("$", "").strip()
    if NUMBER.fullmatch(text):
        return float(text)
    if re.fullmatch(r"[+-]?inf(inity)?", text, re.I):
        return float("-inf") if text.startswith("-") else float("inf")
    return None


def stamp(text):
    text = (text or "").strip()
    if not STAMP.fullmatch(text):
        return None
    try:
        head, _, fraction = text.replace(" ", "T").partition(".")
        return datetime.fromisoformat(head).replace(microsecond=int((fraction + "000000")[:6]))
    except ValueError:
        return None


NUMBERS = [
    "1", "-1", "+1", "1.", ".5", "-.5", "1.5e3", "1E-2", "1.e5", "$231,649.84", " 85000 ", "\t7\n", " 7 ", "", "  ", None,
    "abc", "NaN", "nan", "1.0d", "1.0f", "2D", "0x1p3", "0x10", "0X1P3", "1_000", "1 2", "+-1", "--1", "-", ".", "e5", "1e", "1e+",
    "inf", "-inf", "+Infinity", "INF", "fluffy", "12f", "١", "1e999", "$", "1,2,3", "9" * 40,
]
STAMPS = [
    "2024-03-15", "2024-03-15T10:20", "2024-03-15 10:20:30", "2024-03-15T10:20:30.5", "2024-03-15T10:20:30.123456",
    " 2024-03-15 ", "2023-02-30", "2024-02-29", "2023-02-29", "13/45/2024", "not-a-date", "", None, "2024", "2024-03", "2024-3-15", "2024-03-1T",
    "2024-03-15T", "2024-03-15Z", "2024-03-15T10:20:30Z", "2024-03-15T10:20:30+01:00", "2024-03-15T10:20:30.1Z",
    "2024-03-15T10:20:30.1+01:00", "2024-03-15T25:00:00", "2024-03-15T10:60", "2024-03-15x10:20", "abcd-ef-gh", "+024-01-01",
    "2024-03-15T1:20:30", "2024-03-15T10:20:3", "2024-03-15T10:20:+1", "0001-01-01", "2024-03-15T10:20:30.", "2024-00-10", "2024-03-15T00:0 :00",
]


def _apply(spark, function, values, kind):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", function(F.col("v")).alias("r"))
    assert dict(rows.dtypes)["r"] == kind
    return [r["r"] for r in rows.orderBy("i").collect()]


def test_numbers(spark):
    assert _apply(spark, X.parse_number, NUMBERS, "double") == [number(v) for v in NUMBERS]


def test_timestamps(spark):
    assert _apply(spark, X.parse_timestamp, STAMPS, "timestamp_ntz") == [stamp(v) for v in STAMPS]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-.eExXpdDfF nifNa,$", max_size=8), min_size=20, max_size=60))
def test_numbers_of_any_shape(spark, values):
    assert _apply(spark, X.parse_number, values, "double") == [number(v) for v in values]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.from_regex(r"20[0-9]{2}[-/][0-9]{1,2}-[0-3][0-9]([ T:][0-9]{2}:[0-9:.+Z-]{0,9})?", fullmatch=True), min_size=20, max_size=60))
def test_timestamps_of_many_shapes(spark, values):
    assert _apply(spark, X.parse_timestamp, values, "timestamp_ntz") == [stamp(v) for v in values]


def test_integers(spark):
    got = _apply(spark, X.parse_integer, ["360", "360.0", "36.5", "x", None, "1e3", "3000000000"], "int")
    assert got == [360, 360, None, None, None, 1000, None]


def test_strip_and_blank(spark):
    values = [" fl ", " x　", "", " \t ", None, "a b", "\x1fq", "é ", " é"]
    assert _apply(spark, X.strip, values, "string") == [None if v is None else v.strip() for v in values]
    assert _apply(spark, X.is_blank, values, "boolean") == [v is None or not v.strip() for v in values]


@pytest.mark.parametrize("value, away, even", [(0.125, 0.13, 0.12), (-0.125, -0.13, -0.12), (1.005, 1.0, 1.0), (2.5, 2.5, 2.5)])
def test_two_roundings(spark, value, away, even):
    row = spark.range(1).select(N.round_away(F.lit(value)).alias("a"), N.round_even(F.lit(value)).alias("e")).first()
    assert (row["a"], row["e"]) == (away, even)


def test_null_stays_null_when_clipped(spark):
    rows = spark.createDataFrame([(None,), (-1.0,), (0.5,), (3.0,)], "x double").select(N.clip(F.col("x"), (0, 2)).alias("y"))
    assert [r["y"] for r in rows.collect()] == [None, 0.0, 0.5, 2.0]
