from __future__ import annotations

import itertools

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from campusgrid.operators import joins as J


def merged_plainly(frames):
    """Rows of a full outer join by plain equality: one per choice of rows with a key, and
    one per row without a key."""
    per_survey = []
    for df in frames.values():
        rows = {}
        for key, value in zip(df["UNITID"], df.iloc[:, 1]):
            rows.setdefault(None if pd.isna(key) else int(key), []).append(value)
        per_survey.append(rows)
    out = []
    for key in {k for rows in per_survey for k in rows} - {None}:
        out += [(key, *choice) for choice in itertools.product(*[rows.get(key, [None]) for rows in per_survey])]
    for i, rows in enumerate(per_survey):
        for value in rows.get(None, []):
            out.append((None, *[value if i == k else None for k in range(len(per_survey))]))
    return pd.DataFrame(out, columns=["UNITID", *frames], dtype=object)


def as_set(pdf):
    clean = pdf.astype(object).where(pdf.notna(), None)
    rows = [tuple(None if v is None else str(v).removesuffix(".0") for v in r) for r in clean.values]
    return sorted(rows, key=str)


FRAMES = {
    "HD": pd.DataFrame({"UNITID": [1, 2, 2, None], "NAME": ["a", "b", "c", "d"]}),
    "IC": pd.DataFrame({"UNITID": [2, 3, 2, None], "FEE": ["5", "6", "7", "8"]}),
    "SFA": pd.DataFrame({"UNITID": [4, 2], "AID": ["x", "y"]}),
}


def to_spark(spark, frames):
    out = {}
    for code, pdf in frames.items():
        column = pdf.columns[1]
        rows = [
            (None if pd.isna(r.UNITID) else int(r.UNITID), r[column]) for _, r in pdf.iterrows()
        ]
        out[code] = spark.createDataFrame(rows, f"UNITID bigint, {column} string")
    return out


def test_fixture(spark, rows_of):
    hd = spark.createDataFrame([(1, "a"), (2, "b")], "UNITID bigint, INSTNM string")
    ic = spark.createDataFrame([(2, 10), (3, 20)], "UNITID bigint, TUITION2 int")
    expected = [(1, "a", None), (2, "b", 10), (3, None, 20)]
    for merge in (J.merge_surveys, J.merge_unique_surveys):
        out = merge({"HD": hd, "IC": ic, "EFFY": None})
        assert out.columns == ["UNITID", "HD_INSTNM", "IC_TUITION2"]
        assert rows_of(out) == expected


@pytest.mark.parametrize("split", [1, 2, 1_000_000])
def test_repeated_keys_multiply_and_null_keys_apart(spark, split):
    out = J.merge_surveys(to_spark(spark, FRAMES), split_rows=split).toPandas()
    assert as_set(out) == as_set(merged_plainly(FRAMES))


def test_unique_merge_refuses_repeated_keys(spark):
    with pytest.raises(PySparkException, match="key repeats"):
        J.merge_unique_surveys(to_spark(spark, FRAMES)).collect()


@pytest.mark.parametrize("split", [50, 1_000_000])
def test_hot_key(spark, split):
    """One key holds most rows of one survey; it joins one row of the other."""
    big = spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id) AS UNITID", "id AS V")
    small = spark.createDataFrame([(7, "x"), (-1, "y")], "UNITID bigint, W string")
    out = J.merge_surveys({"A": big, "B": small}, split_rows=split)
    assert out.count() == 3001
    assert out.filter("B_W = 'x'").count() == 1000 + 1
    assert out.filter("A_V IS NULL").count() == 1


def test_nothing_to_merge():
    with pytest.raises(ValueError):
        J.merge_surveys({"HD": None})


def test_related_counts_do_not_multiply(spark, rows_of):
    rows = spark.createDataFrame(
        [("i1", "CA"), ("i1", "CA"), ("i1", "NY"), ("i2", "CA"), ("i3", None)],
        "id string, state string",
    )
    related = spark.createDataFrame([("i1",), ("i1",), ("i2",), ("i9",)], "id string")
    assert rows_of(J.count_related(rows, related, "id", ["state"], "n")) == [
        ("CA", 3),
        ("NY", 2),
        (None, 0),
    ]
    counted = J.add_related_count(rows, related, "id", "n").select("id", "n")
    assert rows_of(counted) == [("i1", 2), ("i1", 2), ("i1", 2), ("i2", 1), ("i3", 0)]


def test_label_lookup(spark, rows_of):
    df = spark.createDataFrame([(1,), (5,), (None,)], "c int")
    out = J.add_label(df, df["c"], {1: "one"}, "label")
    assert rows_of(out) == [(1, "one"), (5, None), (None, None)]


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.lists(st.one_of(st.none(), st.integers(0, 5)), min_size=1, max_size=6),
        min_size=1,
        max_size=3,
    )
)
def test_any_surveys_multiply(spark, keys):
    frames = {
        f"S{i}": pd.DataFrame(
            {"UNITID": pd.array(ks, dtype="Float64"), "V": [f"{i}.{j}v" for j in range(len(ks))]}
        )
        for i, ks in enumerate(keys)
    }
    out = J.merge_surveys(to_spark(spark, frames), split_rows=1).toPandas()
    assert as_set(out) == as_set(merged_plainly(frames))


def test_hot_key_is_spread(spark):
    """The rows of one key reach several tasks."""
    big = spark.range(4000).selectExpr("7 AS UNITID", "id AS V")
    small = spark.createDataFrame([(7, "x")], "UNITID bigint, W string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = J.merge_surveys({"A": big, "B": small}, split_rows=100)
        per_task = out.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in per_task) == 4000
    assert max(r["count"] for r in per_task) < 2500


def per_task(spark, frame):
    """Rows per task, without broadcasts or plans changed at run time."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return [r["count"] for r in frame().groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_equal_rows_of_a_hot_key_are_spread(spark):
    """Three distinct rows, 4000 copies: all come back, from several tasks."""
    big = spark.range(4000).selectExpr("if(id < 2800, 7, id) AS UNITID", "id % 3 AS V")
    small = spark.createDataFrame([(7, "x"), (7, "y")], "UNITID bigint, W string")
    found = per_task(spark, lambda: J.merge_surveys({"A": big, "B": small}, split_rows=100))
    assert sum(found) == 2 * 2800 + 1200
    assert max(found) < sum(found) / 2
    out = J.merge_surveys({"A": big, "B": small}, split_rows=100).filter("UNITID = 7")
    got = {(r["A_V"], r["B_W"]): r["count"] for r in out.groupBy("A_V", "B_W").count().collect()}
    want = {0: 934, 1: 933, 2: 933}
    assert got == {(v, w): n for v, n in want.items() for w in "xy"}


def test_maps_in_a_hot_key(spark):
    big = spark.range(300).selectExpr("7 AS UNITID", "map('a', id) AS M")
    small = spark.createDataFrame([(7, "x")], "UNITID int, W string")
    out = J.merge_surveys({"A": big, "B": small}, split_rows=100)
    assert out.selectExpr("A_M['a'] AS a").distinct().count() == out.count() == 300


def test_rows_of_a_hot_id_stay_in_their_tasks(spark):
    rows = spark.range(0, 4000, 1, 8).selectExpr(
        "if(id % 10 < 7, 'hot', if(id % 10 < 9, string(id), NULL)) AS i", "id % 3 AS v"
    )
    related = spark.createDataFrame([("hot",), ("hot",), ("8",), (None,)], "i string")
    found = per_task(spark, lambda: J.add_related_count(rows, related, "i", "n", split_rows=100))
    assert sum(found) == 4000
    assert max(found) < 800
    out = J.add_related_count(rows, related, "i", "n", split_rows=100)
    got = {r["n"]: r["count"] for r in out.groupBy("n").count().collect()}
    assert got == {2: 2800, 1: 1, 0: 1199}


def test_repeated_key_fails_even_if_the_key_is_not_read(spark):
    one = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "UNITID bigint, n string")
    merged = J.merge_unique_surveys({"HD": one})
    with pytest.raises(Exception, match="key repeats"):
        merged.count()
    with pytest.raises(Exception, match="key repeats"):
        merged.select("HD_n").collect()
