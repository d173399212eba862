from __future__ import annotations

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from campusgrid.operators import quality as Q

F1 = (
    "school_name string, school_state string, student_size bigint, "
    "admission_rate_overall double, completion_rate_overall double"
)


def report(df, **options):
    return {
        (r.severity, r.check, r.column): r.affected_rows
        for r in Q.validation_report(df, **options).collect()
    }


def test_missing_columns(spark):
    df = spark.createDataFrame([("Test University", "CA")], "school_name string, school_state string")
    expected = "admission_rate_overall, completion_rate_overall, student_size"
    with pytest.raises(Q.SchemaError, match=expected):
        Q.validate(df)
    rows = Q.validation_report(df).collect()
    assert [(r.severity, r.check) for r in rows] == [("ERROR", "schema")]
    assert not Q.report_summary(Q.validation_report(df)).first().is_valid


def test_ranges(spark, rows_of):
    df = spark.createDataFrame(
        [
            ("Test 1", "CA", 1000, 0.5, 0.6),
            ("Test 2", "NY", -500, 1.5, 0.7),
            ("Test 3", "TX", 2000, 0.8, -0.1),
        ],
        F1,
    )
    assert [r[0] for r in rows_of(Q.validate(df))] == ["Test 1"]
    found = report(df)
    for column in ("student_size", "admission_rate_overall", "completion_rate_overall"):
        assert found["WARNING", "ranges", column] == 1
    assert found["CORRECTION", "ranges", ""] == 2
    assert found["INFO", "removed_rows", ""] == 2
    flags = Q.flag_out_of_range(df).orderBy("school_name").collect()
    assert [r.out_of_range for r in flags] == [False, True, True]


def test_null_rate(spark):
    rows = [(f"School {i}", "CA", 1000, 0.5, 0.6) for i in range(94)]
    rows += [(None, "CA", 1000, 0.5, 0.6)] * 6
    df = spark.createDataFrame(rows, F1)
    warned = Q.null_warnings(df).collect()
    assert [(r.column, r.null_percent) for r in warned] == [("school_name", 6.0)]
    assert Q.null_warnings(df, threshold=6.0).count() == 0
    assert Q.validate(df).count() == 95
    found = report(df)
    assert found["WARNING", "nulls", "school_name"] == 6
    assert found["CORRECTION", "duplicates", "school_name,school_state"] == 5
    assert found["INFO", "validated_rows", ""] == 95


def test_duplicates(spark):
    df = spark.createDataFrame(
        [
            ("School A", "CA", 1000, 0.5, 0.8),
            ("School B", "NY", 2000, 0.6, 0.7),
            ("School A", "CA", 1000, 0.5, 0.8),
            ("School C", "TX", 3000, 0.7, 0.9),
        ],
        F1,
    )
    assert Q.validate(df).count() == 3
    counts = Q.duplicate_counts(df).first()
    assert (counts.rows_involved, counts.rows_to_remove, counts.groups) == (2, 1, 1)
    assert Q.duplicate_counts(df, keep=False).first().rows_to_remove == 2
    assert Q.deduplicate(df, keep=False).count() == 2
    kept = report(df, remove_duplicates=False)
    assert kept["INFO", "validated_rows", ""] == 4


def test_clean_rows_raise_nothing(spark):
    df = spark.createDataFrame(
        [
            ("MIT", "MA", 10000, 0.07, 0.95),
            ("Stanford", "CA", 15000, 0.04, 0.94),
            ("Harvard", "MA", 20000, 0.05, 0.97),
        ],
        F1,
    )
    assert Q.validate(df).count() == 3
    assert {k[0] for k in report(df)} == {"INFO"}
    summary = Q.report_summary(Q.validation_report(df)).first()
    assert (summary.errors, summary.warnings, summary.is_valid) == (0, 0, True)


def test_second_occurrence_survives_when_the_first_is_out_of_range(spark):
    df = spark.createDataFrame([("A", "CA", -1, 0.5, 0.5), ("A", "CA", 10, 0.5, 0.5)], F1)
    assert [r.student_size for r in Q.validate(df).collect()] == [10]


def test_nan_is_missing_not_out_of_range(spark):
    df = spark.createDataFrame([("A", "CA", 10, float("nan"), 0.5)], F1)
    row = Q.validate(df).first()
    assert row.admission_rate_overall is None
    assert Q.keep_in_range(df).count() == 1
    assert ("CORRECTION", "types", "admission_rate_overall") not in report(df)


def test_coercion_losses(spark):
    df = spark.createDataFrame(
        [("A", "CA", v, "0.5", "x") for v in ("1d", "1,000", " 12 ", None)],
        "school_name string, school_state string, student_size string, "
        "admission_rate_overall string, completion_rate_overall string",
    )
    lost = {r.column: r.lost for r in Q.coercion_losses(df).collect()}
    assert lost["student_size"] == 2
    assert lost["completion_rate_overall"] == 4
    assert lost["admission_rate_overall"] == 0
    assert report(df)["CORRECTION", "types", "student_size"] == 2


def test_empty_input(spark):
    df = spark.createDataFrame([], F1)
    assert Q.validate(df).count() == 0
    assert report(df) == {
        ("INFO", "total_rows", ""): 0,
        ("INFO", "validated_rows", ""): 0,
        ("INFO", "removed_rows", ""): 0,
    }
    assert all(r.null_percent is None for r in Q.null_counts(df).collect())


@pytest.mark.parametrize("keep", ["first", "last", False])
def test_deduplicate_like_pandas(spark, keep):
    rows = [
        (i, None if i % 7 == 0 else f"n{i % 5}", f"s{i % 2}", i * 37 % 11) for i in range(60)
    ] + [(60, "only", "one", 1)]
    df = spark.createDataFrame(rows, "pos int, name string, state string, v int").repartition(7)
    got = Q.deduplicate(df, ("name", "state"), keep, ["pos"]).toPandas()
    want = pd.DataFrame(rows, columns=["pos", "name", "state", "v"]).drop_duplicates(
        ["name", "state"], keep=keep
    )
    assert sorted(got["pos"]) == sorted(want["pos"])


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["A", "B", None]),
            st.sampled_from(["CA", "NY", None]),
            st.one_of(st.none(), st.integers(-3, 9)),
            st.one_of(st.none(), st.floats(-0.5, 1.5)),
            st.one_of(st.none(), st.floats(-0.5, 1.5)),
        ),
        min_size=1,
        max_size=25,
    )
)
def test_report_agrees_with_the_rows(spark, rows):
    df = spark.createDataFrame(rows, F1)
    found = report(df)
    assert found["INFO", "total_rows", ""] == len(rows)
    assert found["INFO", "validated_rows", ""] == Q.validate(df).count()


def test_hot_key_keeps_all_other_rows(spark):
    """A third of the rows share one key."""
    rows = [("hot", "CA", i, 0.5, 0.5) for i in range(1000)]
    rows += [(f"n{i}", "CA", i, 0.5, 0.5) for i in range(2000)]
    df = spark.createDataFrame(rows, F1).repartition(8)
    out = Q.validate(df, order_by=["student_size"])
    assert out.count() == 2001
    assert out.filter("school_name = 'hot'").first().student_size == 0
    assert report(df)["CORRECTION", "duplicates", "school_name,school_state"] == 999


def test_distribution_and_range(spark):
    df = spark.createDataFrame(
        [("small", 1.0), ("small", 2.0), (None, None), ("large", 6.0)], "size_category string, v double"
    )
    shares = {r.size_category: (r.rows, r.percent) for r in Q.class_shares(df).collect()}
    assert shares == {"small": (2, 50.0), None: (1, 25.0), "large": (1, 25.0)}
    row = Q.value_range(df, ["v"]).first()
    assert (row["values"], row["min"], row["max"], row["mean"]) == (3, 1.0, 6.0, 3.0)


def test_unique_key(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "school_id int")
    assert [tuple(r) for r in Q.repeated_keys(df).collect()] == [(1, 2)]


def test_nan_counts_as_missing_in_statistics(spark):
    df = spark.createDataFrame(
        [("a", 0.5), ("b", float("nan")), ("c", 0.7)], "school_state string, admission_rate_overall double"
    )
    stats = {(r["metric"], r["column"]): r["value"] for r in Q.extraction_stats(df).collect()}
    assert round(stats["avg_admission_rate", "admission_rate_overall"], 6) == 0.6
    filled = Q.completeness(df, ["admission_rate_overall"]).first()
    assert filled["filled"] == 2
    found = Q.value_range(df, ["admission_rate_overall"]).first()
    assert (found["values"], found["max"], round(found["mean"], 6)) == (2, 0.7, 0.6)
