from __future__ import annotations

import pytest

from campusgrid.operators import clean as C

RAW = (
    "school_name string, school_state string, student_size bigint, "
    "admission_rate_overall double, completion_rate_overall double"
)
CLEAN = RAW.replace("_overall", "")


def test_renames(spark):
    df = spark.createDataFrame([("A", "CA", 1000, 0.5, 0.7), ("B", "NY", 2000, 0.6, 0.8)], RAW)
    names = C.standardize_columns(df).columns
    assert {"admission_rate", "completion_rate"} <= set(names)
    assert "admission_rate_overall" not in names


def test_colliding_names_are_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "`School Name` int, `school-name` int")
    with pytest.raises(ValueError, match="school_name"):
        C.standardize_columns(df)


def test_prefix(spark):
    df = spark.createDataFrame([(1, "x")], "UNITID int, INSTNM string")
    assert C.prefix_columns(df, "HD", ["UNITID"]).columns == ["UNITID", "HD_INSTNM"]


def test_derived_columns(spark):
    df = spark.createDataFrame(
        [("A", "CA", 3000, 0.5, 0.8), ("B", "NY", 10000, 0.75, 0.6), ("C", "TX", 20000, 0.25, 0.9)],
        CLEAN,
    )
    out = C.derive(df).orderBy("school_name").collect()
    assert out[0].admission_rate_percentage == 50.0
    assert out[1].completion_rate_percentage == 60.0
    assert [r.size_category for r in out] == ["small", "medium", "large"]


def test_derive_without_inputs(spark):
    df = spark.createDataFrame([(1,)], "other int")
    assert C.derive(df).columns == ["other"]


def test_integrity(spark, rows_of):
    df = spark.createDataFrame(
        [
            ("A", "CA", 1000, 0.5, 0.8),
            ("A", "CA", 1000, 0.5, 0.8),
            ("B", "NY", -500, 0.6, 0.7),
            ("C", "TX", 2000, 0.7, 0.9),
        ],
        CLEAN,
    )
    kept = C.drop_negatives(C.drop_exact_duplicates(df))
    assert [r[0] for r in rows_of(kept)] == ["A", "C"]
    assert tuple(C.integrity_counts(df).first()) == (4, 1, 1, 2)


def test_null_is_not_negative(spark):
    df = spark.createDataFrame([("A", None, None, None, None)], CLEAN)
    assert C.drop_negatives(df).count() == 1


def test_transform(spark):
    df = spark.createDataFrame(
        [
            ("MIT", "ma", 11000, 0.07, 0.95),
            ("Stanford", "ca", 17000, 0.04, 0.94),
            ("Harvard", "ma", 21000, 0.05, 0.97),
        ],
        RAW,
    )
    out = {r.school_name: r for r in C.transform(df).collect()}
    assert len(out) == 3
    assert [out[n].school_state for n in ("MIT", "Stanford", "Harvard")] == ["MA", "CA", "MA"]
    assert abs(out["MIT"].admission_rate_percentage - 7.0) < 0.01
    assert [out[n].size_category for n in ("MIT", "Stanford", "Harvard")] == [
        "medium",
        "large",
        "large",
    ]


def test_clean_counts_and_values(spark):
    df = spark.createDataFrame(
        [("\tTest \n", " ca ", "12"), ("None", "NY", "1d"), (None, "nan", None), ("x", "Texas", "3")],
        "school_name string, school_state string, student_size string",
    )
    counts = C.cleaning_counts(df).first()
    assert (counts.rows, counts.cells_trimmed, counts.states_changed, counts.odd_states) == (
        4,
        2,
        2,
        1,
    )
    out = C.clean(df).collect()
    assert [tuple(r) for r in out] == [
        ("Test", "CA", 12.0),
        (None, "NY", None),
        (None, None, None),
        ("x", "TEXAS", 3.0),
    ]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([("a", float("nan"))], "school_name string, admission_rate double")
    assert C.clean(df).first().admission_rate is None


def test_empty_table(spark):
    df = spark.createDataFrame([], RAW)
    assert C.transform(df).count() == 0
    assert tuple(C.cleaning_counts(df).first()) == (0, 0, 0, 0)
    assert tuple(C.integrity_counts(C.standardize_columns(df)).first()) == (0, 0, 0, 0)
