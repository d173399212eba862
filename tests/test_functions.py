from __future__ import annotations

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from campusgrid.functions import classes as K
from campusgrid.functions import numbers as N
from campusgrid.functions import text as X
from campusgrid.schema import FIELD_TO_COLUMN, OWNERSHIP_LABELS


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("schoolName", "school_name"),
        ("School Name", "school_name"),
        ("SCHOOL_NAME", "school_name"),
        ("admission_rate_overall", "admission_rate_overall"),
        ("CamelCaseColumn", "camel_case_column"),
        ("_extracted_at", "extracted_at"),
        ("APIKey", "apikey"),
        ("2ndYear", "2nd_year"),
        ("a.b", "a.b"),
        ("school-name", "school_name"),
        ("  a  b ", "a_b"),
    ],
)
def test_snake_case(name, expected):
    assert X.snake_case(name) == expected


@given(st.text(alphabet="aB1_- ", max_size=12))
def test_snake_case_is_stable(name):
    once = X.snake_case(name)
    assert X.snake_case(once) == once
    assert "__" not in once and once == once.strip("_").lower()


def test_field_names():
    assert X.field_column_name("school.name", FIELD_TO_COLUMN) == "school_name"
    assert X.field_column_name("latest.Some-thing", FIELD_TO_COLUMN) == "latest_some_thing"
    assert X.without_prefixes("latest.school.city") == "city"
    assert X.without_prefixes("school.latest.x") == "latest_x"
    assert X.without_prefixes("location.lat") == "location_lat"


def test_strip_removes_what_python_removes(spark):
    every = [chr(c) for c in range(1, 0x3001) if chr(c).isspace()]
    rows = [(f"{c}a{c} b{c}",) for c in every]
    out = spark.createDataFrame(rows, "v string").select("v", X.strip(F.col("v")).alias("s"))
    assert all(r.s == r.v.strip() for r in out.collect())
    assert set(X.BLANKS) == set(every)


def test_null_tokens(spark):
    values = ["nan", "None", "NaN", "", "null", "NULL", "Null", "  ", "\tTest \n", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r.c for r in df.select("i", X.clean_text(F.col("v")).alias("c")).orderBy("i").collect()]
    assert got == [None] * 6 + ["Null", None, "Test", None]


def test_state_code(spark):
    values = [" ca", "None", "nan", "Ca\t", None, "new"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r.c for r in df.select("i", X.state_code(F.col("v")).alias("c")).orderBy("i").collect()]
    assert got == ["CA", None, None, "CA", None, "NEW"]


@pytest.mark.parametrize(
    ("text", "double", "whole"),
    [
        ("1d", None, None),
        ("1,000", None, None),
        (" 12 ", 12.0, 12),
        ("3.5", 3.5, None),
        ("12.0", 12.0, 12),
        ("1e3", 1000.0, 1000),
        ("-7", -7.0, -7),
        (".5", 0.5, None),
        ("NaN", None, None),
        ("", None, None),
        ("9007199254740993", 9007199254740992.0, 9007199254740993),
        (None, None, None),
    ],
)
def test_number_text(spark, text, double, whole):
    df = spark.createDataFrame([(text,)], "v string")
    kind = df.schema["v"].dataType
    row = df.select(N.to_double(F.col("v"), kind), N.to_long(F.col("v"), kind)).first()
    assert (row[0], row[1]) == (double, whole)


def test_numbers_that_are_numbers(spark):
    df = spark.createDataFrame([(1.0, 3), (2.5, None), (float("nan"), 4)], "d double, n int")
    d, n = df.schema["d"].dataType, df.schema["n"].dataType
    out = df.select(N.to_double(F.col("d"), d), N.to_long(F.col("d"), d), N.to_long(F.col("n"), n))
    assert [tuple(r) for r in out.collect()] == [(1.0, 1, 3), (2.5, None, None), (None, None, 4)]


@pytest.mark.parametrize(
    ("size", "expected"),
    [(4999, "small"), (5000, "medium"), (15000, "medium"), (15001, "large"), (None, None)],
)
def test_size_category(spark, size, expected):
    df = spark.createDataFrame([(size,)], "n double" if size is None else "n int")
    assert df.select(K.size_category(F.col("n"))).first()[0] == expected


def test_labels_and_ratios(spark):
    df = spark.createDataFrame([(1, 10.0, 0.0), (9, 10.0, 4.0), (None, None, 4.0)], "c int, a double, b double")
    out = df.select(
        K.code_label(F.col("c"), OWNERSHIP_LABELS), N.ratio(F.col("a"), F.col("b"))
    ).collect()
    assert [r[0] for r in out] == ["Public", None, None]
    assert [None if r[1] is None else float(r[1]) for r in out] == [None, 2.5, None]


def test_percent_rounds_half_up(spark):
    df = spark.createDataFrame([(0.00125,), (0.50005,), (0.7,)], "r double")
    assert [str(r[0]) for r in df.select(N.as_percent(F.col("r"))).collect()] == [
        "0.13",
        "50.01",
        "70.00",
    ]


def test_attribute(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, None)], "k int, v string"
    )
    got = dict(df.groupBy("k").agg(N.attribute(F.col("v")).alias("v")).collect())
    assert got == {1: "a", 2: "*", 3: None}


@pytest.mark.parametrize(
    ("a", "c", "expected"),
    [
        (0.2, 0.9, "Selective + High Completion"),
        (0.7, 0.71, "Open + High Completion"),
        (0.1, 0.4, "Selective + Low Completion"),
        (0.9, 0.3, "Open + Low Completion"),
        (0.3, 0.9, "Average"),
        (0.9, 0.7, "Average"),
    ],
)
def test_profile(spark, a, c, expected):
    df = spark.createDataFrame([(a, c)], "a double, c double")
    assert df.select(K.rate_profile(F.col("a"), F.col("c"))).first()[0] == expected
