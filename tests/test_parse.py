"""Edge cells of every parser."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starmill.functions import parse
from starmill.functions.text import is_missing, labelled, tokens_to_null

D = Decimal
CASES = {
    parse.parse_rating: [
        ("0", D("0.00")),
        ("5", D("5.00")),
        ("5.001", None),
        ("4.999", D("5.00")),
        ("4.565", D("4.57")),
        ("5." + "0" * 33 + "1", None),
        ("19", None),
        ("9" * 60, None),
        (" 4.1 ", D("4.10")),
        ("-1", None),
        (".5", None),
        ("5.", None),
        ("NaN", None),
        ("4.1\n", None),
        ("", None),
        ("  ", None),
        (None, None),
    ],
    parse.parse_count: [
        ("0", 0),
        ("159", 159),
        (" 7 ", 7),
        ("3.0M", None),
        ("1,000", None),
        ("41\n", None),
        ("9223372036854775807", 9223372036854775807),
        ("9223372036854775808", None),
        ("1" * 40, None),
        (None, None),
    ],
    parse.parse_size: [
        ("19M", 19922944),
        ("4.9m", 5138022),
        ("201k", 205824),
        ("8.5K", 8704),
        ("0.0005k", 1),
        ("Varies with device", None),
        ("1,000+", None),
        ("12", None),
        ("M", None),
        ("1M\n", None),
        ("", None),
        ("9007199254740991k", 9223372036854774784),
        ("99999999999999999999M", None),
        (None, None),
    ],
    parse.parse_installs: [
        ("10,000+", 10000),
        ("Free", None),
        ("0", 0),
        ("-5", 5),
        ("", None),
        ("9" * 25, None),
        (None, None),
    ],
    parse.parse_price: [
        ("$4.99", D("4.99")),
        ("0", D("0.00")),
        ("Everyone", None),
        ("1.2.3", None),
        ("-2", D("2.00")),
        ("1.005", D("1.01")),
        ("  ", None),
        (".", None),
        (None, None),
    ],
    parse.parse_date: [
        ("7-Jan-18", dt.date(2018, 1, 7)),
        ("07-JAN-18", dt.date(2018, 1, 7)),
        (" 7-jan-18 ", dt.date(2018, 1, 7)),
        ("1-Feb-70", dt.date(1970, 2, 1)),
        ("1-Feb-69", dt.date(2069, 2, 1)),
        ("31-Dec-99", dt.date(1999, 12, 31)),
        ("29-Feb-72", dt.date(1972, 2, 29)),
        ("29-Feb-00", dt.date(2000, 2, 29)),
        ("31-Feb-18", None),
        ("1-Foo-18", None),
        ("January 7, 2018", None),
        ("7-Jan-2018", None),
        ("", None),
        (None, None),
    ],
    parse.parse_text: [(" a b ", "a b"), ("   ", None), ("", None), ("NaN", "NaN"), (None, None)],
}


@pytest.mark.parametrize("parser", CASES, ids=lambda p: p.__name__)
def test_cells(spark, parser):
    cases = CASES[parser]
    cells = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, c string")
    got = {r.i: r.v for r in cells.select("i", parser(F.col("c")).alias("v")).collect()}
    assert {cases[i][0]: v for i, v in got.items()} == dict(cases)


def test_unreadable_marks_right_shape_without_value(spark):
    cells = [
        ("count", "1" * 40, True),
        ("count", "x", False),
        ("size", "99999999999999999999M", True),
        ("size", "Varies with device", False),
        ("installs", "9" * 25, True),
        ("installs", "none", False),
        ("price", "1.2.3", True),
        ("price", "Everyone", False),
        ("date", "31-Feb-18", True),
        ("date", "soon", False),
    ]
    for kind, cell, expected in cells:
        df = spark.createDataFrame([(cell,)], "c string")
        assert df.select(parse.unreadable(F.col("c"), kind)).first()[0] is expected, (kind, cell)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.decimals(min_value=0, max_value=9, places=4), min_size=1, max_size=30))
def test_rating_rounds_half_up_after_the_range_test(spark, values):
    df = spark.createDataFrame([(str(v),) for v in values], "c string")
    got = [r.v for r in df.select(parse.parse_rating(F.col("c")).alias("v")).collect()]
    cent = Decimal("0.01")
    assert got == [
        v.quantize(cent, rounding="ROUND_HALF_UP") if v <= 5 else None for v in values
    ]


def test_null_tokens(spark):
    cells = ["NaN", " null ", "n/a", "NA", "", "  ", None, "1.0", " x "]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    rows = df.select(
        is_missing(F.col("c"), ("nan", "null")).alias("assess"),
        tokens_to_null(F.col("c"), ("nan", "null", "n/a", "na")).alias("clean"),
    ).collect()
    assert [r.assess for r in rows] == [True, True, False, False, True, True, True, False, False]
    assert [r.clean for r in rows] == [None] * 7 + ["1.0", "x"]


def test_labelled_keeps_null_parts(spark):
    df = spark.createDataFrame([("a", None)], "x string, y int")
    assert df.select(labelled(("x", F.col("x")), ("y", F.col("y")))).first()[0] == "x=a; y=NULL"
