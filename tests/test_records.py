from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from campusgrid.schema import EXTENDED_FIELD_TO_COLUMN, NESTED_PATHS
from campusgrid.sources import presets as P
from campusgrid.sources import records as R

FLAT = {
    "id": 100654,
    "school.name": "Alabama A & M University",
    "school.state": "AL",
    "school.city": "Normal",
    "school.zip": "35762",
    "school.school_url": "www.aamu.edu/",
    "school.ownership": 1,
    "school.region_id": 5,
    "school.locale": 12,
    "school.operating": 1,
    "latest.student.size": 6207,
    "latest.student.grad_students": 900,
    "latest.admissions.admission_rate.overall": 0.8209,
    "latest.completion.rate_suppressed.overall": 0.2912,
    "latest.completion.rate_suppressed.four_year": None,
    "latest.cost.tuition.in_state": 10024,
    "latest.cost.tuition.out_of_state": 18634,
    "latest.aid.median_debt.completers.overall": 15250,
    "latest.earnings.10_yrs_after_entry.median": 40628,
    "location.lat": 34.783368,
    "location.lon": -86.568502,
}


def page(results, n=0):
    return {"metadata": {"total": 3, "page": n, "per_page": 100}, "results": results}


def test_pages(spark, tmp_path):
    odd = {**FLAT, "id": 2, "latest.student.size": "n/a", "school.state": None}
    contents = [page([FLAT, odd]), page(None, 1), page([], 2), page([{"id": 3}], 3)]
    for i, content in enumerate(contents):
        (tmp_path / f"page_{i}.json").write_text(json.dumps(content, indent=1))
    table = R.records_to_table(R.read_pages(spark, str(tmp_path)), "api")
    rows = {r.school_id: r for r in table.collect()}
    assert sorted(rows) == [2, 3, 100654]
    first = rows[100654]
    assert (first.school_name, first.student_size) == ("Alabama A & M University", 6207)
    assert (first.admission_rate_overall, first.completion_rate_4yr) == (0.8209, None)
    assert (first.longitude, first._source) == (-86.568502, "api")
    assert first._extracted_at is not None
    assert (rows[2].student_size, rows[2].school_state) == (None, None)
    assert len(table.columns) == 23


@pytest.mark.parametrize("text", ['{"metadata": {}}', "not json", "[1]", '{"results": [{"id": 1}'])
def test_broken_page_fails(spark, text):
    pages = spark.createDataFrame([(text,)], "value string")
    with pytest.raises(PySparkException, match="page without results"):
        R.page_records(pages, "value").collect()


@pytest.mark.parametrize("multi_line", [False, True])
def test_record_array_file(spark, tmp_path, multi_line):
    path = tmp_path / "records.json"
    path.write_text(json.dumps([FLAT, {**FLAT, "id": 7}], indent=2 if multi_line else None))
    out = R.read_records(spark, str(path), multi_line=multi_line)
    assert sorted(r.id for r in out.collect()) == ["100654", "7"]


def test_colliding_field_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `a-b` int")
    with pytest.raises(ValueError, match="a_b"):
        R.records_to_table(df, "x")
    other = spark.createDataFrame([(1, 2)], "`latest.name` int, `school.name` int")
    with pytest.raises(ValueError, match="name"):
        R.short_names(other)


@pytest.fixture
def nested(spark):
    text = json.dumps(
        {
            "id": 1,
            "latest": {
                "school": {"name": "A", "state": None},
                "student": {"size": 10},
                "tags": [1, 2],
            },
        }
    )
    return spark.read.json(spark.sparkContext.parallelize([text]))


def test_value_at(nested):
    schema = nested.schema
    row = nested.select(
        R.value_at(schema, "latest.student.size"),
        R.value_at(schema, ("latest", "school", "name")),
        R.value_at(schema, "latest.school.city", default="none"),
        R.value_at(schema, "latest/student/size", separator="/"),
        R.value_at(schema, ("id", "x")),
    ).first()
    assert tuple(row) == (10, "A", "none", 10, None)


def test_normalize(nested):
    out = R.normalize(nested)
    assert out.columns == [
        "id",
        "latest.school.name",
        "latest.school.state",
        "latest.student.size",
        "latest.tags",
    ]
    assert tuple(out.first()) == (1, "A", None, 10, [1, 2])


def test_field_presence(nested):
    rows = {r.field: r for r in R.field_presence(nested, NESTED_PATHS).collect()}
    assert (rows["school.name"]["exists"], rows["school.name"].present_rows) == (True, 1)
    assert rows["school.state"].present_rows == 0
    gone = rows["latest.admissions.admission_rate.overall"]
    assert (gone["exists"], gone.found_path, gone.available) == (
        False,
        "latest",
        "school,student,tags",
    )


def test_extended_table(spark):
    record = {k: None for k in EXTENDED_FIELD_TO_COLUMN} | {k: str(v) for k, v in FLAT.items()}
    schema = ", ".join(f"`{k}` string" for k in EXTENDED_FIELD_TO_COLUMN)
    values = [tuple(record[k] for k in EXTENDED_FIELD_TO_COLUMN)]
    out = R.extended_table(spark.createDataFrame(values, schema), "api")
    assert len(out.columns) == 37
    assert out.columns[:7] == [
        "school_id",
        "school_name",
        "school_state",
        "school_city",
        "student_size",
        "admission_rate_overall",
        "completion_rate_overall",
    ]
    row = out.first()
    assert (row.ownership_label, row.region_label) == ("Public", "Southeast")
    assert (row.undergrad_size, row.tuition_difference) == (5307, 8610)
    assert row.completion_rate_4yr is None


def test_derived_nulls(spark):
    df = spark.createDataFrame(
        [(None, 5, 3, None), (10, None, None, None), (10, 4, None, 7)],
        "student_size int, grad_students int, tuition_in_state int, tuition_out_of_state int",
    )
    out = [(r.undergrad_size, r.tuition_difference) for r in R.with_labels_and_sizes(df).collect()]
    assert out == [(None, -3), (10, 0), (6, 7)]


def test_read_table_by_ending(spark, tmp_path):
    df = spark.createDataFrame([(1, ' a "b", '), (2, None)], "n int, s string")
    df.write.parquet(str(tmp_path / "t.parquet"))
    from campusgrid.sources.sinks import write_csv

    write_csv(df, str(tmp_path / "t.csv"))
    for name in ("t.parquet", "t.csv"):
        got = R.read_table(spark, str(tmp_path / name), df.schema).orderBy("n").collect()
        assert [tuple(r) for r in got] == [(1, ' a "b", '), (2, None)]
    with pytest.raises(ValueError):
        R.read_table(spark, str(tmp_path / "t.xlsx"))


# --- presets ---------------------------------------------------------------


@pytest.fixture
def flat(spark):
    rows = [
        (1, "A", "CA", 1, 1, 20000, 3),
        (2, "B", "CA", 2, 0, 900, 1),
        (3, "C", "NY", 3, 1, None, 3),
    ]
    return spark.createDataFrame(
        rows,
        "id int, `school.name` string, `school.state` string, `school.ownership` int, "
        "`school.operating` int, `latest.student.size` int, "
        "`school.degrees_awarded.predominant` int",
    )


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_group_fields():
    assert P.group_fields(["programs", "unknown"], ["id"])[0] == "id"
    assert len(P.group_fields()) == 14
    fields = P.group_fields(["basic", "cost"])
    assert fields == sorted(set(fields)) and len(fields) == 15


def test_row_filters(flat):
    assert ids(flat.filter(P.row_filter())) == [1, 2, 3]
    assert ids(flat.filter(P.row_filter(state="CA", min_size=1000))) == [1]
    assert ids(flat.filter(P.row_filter(operating=True))) == [1, 3]
    assert ids(flat.filter(P.row_filter(ownership=2))) == [2]
    assert ids(flat.filter(P.row_filter(degree=3, equal={"school.name": "C"}))) == [3]
    assert ids(flat.filter(P.row_filter(min_size=0))) == [1, 2, 3]


def test_presets(flat):
    assert ids(P.preset(flat, "public_universities")) == [1]
    assert ids(P.preset(flat, "private_nonprofit")) == [2]
    assert ids(P.preset(flat, "by_state", state="NY")) == [3]
    assert ids(P.large_institutions(flat)) == [1]
    assert ids(P.by_state(flat, "CA")) == [1, 2]
    assert P.count_matching(flat) == 2
    assert P.count_matching(flat, operating=False, state="CA") == 2
    with pytest.raises(ValueError):
        P.preset(flat, "by_state")
    with pytest.raises(ValueError):
        P.preset(flat, "nothing")
    assert "latest.student.size" in P.all_institutions(flat).columns
    assert "latest.student.size" not in P.preset(flat, "costs_and_aid").columns


def test_first_pages(spark):
    df = spark.range(1000).select(F.col("id"))
    assert [r.id for r in P.first_pages(df, ["id"], pages=2, page_size=3).collect()] == list(range(6))
    assert P.first_pages(df, ["id"], pages=2, max_records=50).count() == 50
    assert P.first_pages(df, ["id"]).count() == 1000


@pytest.mark.parametrize(
    "page",
    ['{"results":[{"id":1},"oops",{"id":2}]}', '{"results":"oops"}', '{"results":{"error":"x"}}'],
)
def test_broken_records_fail_the_page(spark, page):
    pages = spark.createDataFrame([(page,)], "value string")
    with pytest.raises(Exception):
        R.page_records(pages, "value").count()


def test_arrays_of_records_become_rows(spark):
    schema = "id int, a struct<items: array<struct<x: int, tags: array<string>>>>"
    rows = [(1, ([(7, ["p", "q"]), (8, None)],)), (2, ([],)), (3, (None,)), (4, None)]
    df = spark.createDataFrame(rows, schema)
    flat = R.normalize(df, explode=["a.items"])
    assert flat.columns == ["id", "a.items.position", "a.items.x", "a.items.tags"]
    got = [tuple(r) for r in flat.orderBy("id", "`a.items.position`").collect()]
    assert got == [(1, 0, 7, ["p", "q"]), (1, 1, 8, None), (2, None, None, None), (3, None, None, None), (4, None, None, None)]
    deep = R.normalize(df, "_", explode=["a_items", "a_items_tags"])
    assert sorted(map(tuple, deep.filter("id = 1").collect()), key=str) == [(1, 0, 7, 0, "p"), (1, 0, 7, 1, "q"), (1, 1, 8, None, None)]
    assert R.normalize(df.limit(0), explode=["a.items"]).count() == 0
    for wrong in ("id", "a.none"):
        with pytest.raises(ValueError, match="no array"):
            R.normalize(df, explode=[wrong])
    with pytest.raises(ValueError, match="share a name"):
        R.normalize(df.withColumn("a_items_position", F.lit(1)), "_", explode=["a_items"])


def test_lists_of_lists_become_lists(spark):
    df = spark.createDataFrame([(1, [[1, 2], [], None, [3]]), (2, None), (3, [])], "id int, v array<array<int>>")
    assert [r["v"] for r in R.flatten_lists(df, ["v"]).orderBy("id").collect()] == [[1, 2, 3], None, []]
    with pytest.raises(ValueError, match="no lists"):
        R.flatten_lists(df, ["id"])


def test_absent_fields_are_typed_nulls(spark):
    out = P.select_fields(spark.createDataFrame([(5,)], "id int"), ["basic", "enrollment"])
    types = dict(out.dtypes)
    assert types["id"] == "int" and types["school.name"] == "string" and types["latest.student.size"] == "bigint"
    assert types["latest.student.part_time_share"] == "double"
    assert sum(v is not None for v in out.first()) == 1
