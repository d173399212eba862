from __future__ import annotations

import pytest

from campusgrid.plans import workbook as W
from campusgrid.schema import SHEET_STATES

SHEET = (
    "`Instruction ID` string, `State or Province` string, `Postal Code` int, `Group` string, "
    "`Sub-Group` string, Revenue double, Qty int, Reduction double"
)


@pytest.fixture
def sheet(spark):
    rows = [
        ("i1", "Ohio", 1, "Technology", "Phones", 100.0, 19, 0.1),
        ("i1", "Ohio", 1, "Furniture", "Chairs", 50.0, 6, 0.3),
        ("i2", "New York", 2, "Technology", "Phones", 500.0, 7, 0.0),
        ("i3", None, 3, "Office Supplies", "Paper", 70.0, 5, 0.2),
        ("i4", "Iowa", 4, "Technology", "Phones", 300.0, 20, 0.2),
        ("i5", "Iowa", 4, "Office Supplies", "Paper", 90.0, 8, 0.2),
        ("i6", "Guam", 5, "Technology", "Paper", 1.0, 8, None),
    ]
    return spark.createDataFrame(rows, SHEET)


@pytest.fixture
def paid(spark):
    return spark.createDataFrame(
        [("Yes", "i1"), ("Yes", "i1"), ("Yes", "i5")], "Reimbursed string, `Instruction ID` string"
    )


def test_state_list():
    assert len(SHEET_STATES) == 49 and list(SHEET_STATES) == sorted(SHEET_STATES)


def test_places(sheet, rows_of):
    assert rows_of(W.product_places(sheet)) == [
        ("Iowa", 4, "Office Supplies"),
        ("New York", 2, "Technology"),
        ("Ohio", 1, "Furniture"),
        ("Ohio", 1, "Technology"),
    ]
    assert rows_of(W.technology_places(sheet)) == [("Ohio", 1, "Technology")]


def test_reimbursements(sheet, paid, rows_of):
    assert rows_of(W.reimbursement_places(sheet, paid)) == [("Iowa", 4, 1), ("Ohio", 1, 2)]
    assert rows_of(W.reimbursement_places(sheet, paid, 0, 0)) == [
        ("Guam", 5, 0),
        ("New York", 2, 0),
        (None, 3, 0),
    ]


def test_reductions(sheet):
    rows = {(r[0], r[1]): r for r in W.reductions(sheet).collect()}
    assert rows["Guam", "Paper"].avg_reduction is None
    assert rows["Iowa", "Phones"].group == "Technology"


def test_state_revenue(sheet):
    rows = W.state_revenue(sheet, low=60, high=400).collect()
    assert [(r[0], r[1], r.revenue, r.sort_revenue) for r in rows] == [
        ("Iowa", "Office Supplies", 90.0, 300.0),
        ("Iowa", "Technology", 300.0, 300.0),
        ("Ohio", "Technology", 100.0, 100.0),
        (None, "Office Supplies", 70.0, None),
    ]


def test_revenue_by_group(sheet):
    assert W.revenue_by_group(sheet).count() == 5


@pytest.fixture
def schools(spark):
    rows = [
        ("a", "S1", 10.0, 0.9, 0.3, "small"),
        ("b", "S1", 20.0, 0.7, 0.5, "small"),
        ("a", "S2", 99.0, 0.5, 0.7, "large"),
        ("c", "S2", 5.0, None, 0.9, "small"),
        (None, "S3", 1.0, 1.0, None, None),
    ]
    return spark.createDataFrame(
        rows,
        "school_name string, school_state string, student_size double, admission_rate double, "
        "completion_rate double, size_category string",
    )


def test_least_selective(schools):
    rows = W.least_selective_states(schools, min_schools=2, low=0.4).collect()
    assert [(r.school_state, r.avg_admission_rate) for r in rows] == [("S1", 0.8), ("S2", 0.5)]
    assert {r.reference_line for r in rows} == {0.65}
    assert W.least_selective_states(schools, 1, 2, 0.0).count() == 1


def test_trend(schools):
    points = {r.school_name: r for r in W.rate_points(schools).collect()}
    assert points["a"].avg_admission_rate == 0.7
    assert "c" not in points
    flat = W.rate_trend(schools).first()
    assert (flat.points, flat.slope, flat.correlation) == (2, None, None)
    tilted = schools.filter("school_state <> 'S2' OR school_name = 'c'").unionByName(
        schools.filter("school_state = 'S1'").selectExpr(
            "'z' AS school_name", "school_state", "student_size", "0.5 AS admission_rate",
            "0.1 AS completion_rate", "size_category",
        )
    )
    line = W.rate_trend(tilted).first()
    assert line.points == 3
    assert abs(line.correlation**2 - line.r2) < 1e-12


def test_state_completion(schools):
    rows = W.state_completion(schools, 2).collect()
    assert [(r.school_state, r.schools) for r in rows] == [("S2", 2), ("S1", 2)]
    assert rows[0].reference_line == pytest.approx(0.6)


def test_size_shares(schools):
    shares = {r.size_category: r.share for r in W.size_shares(schools).collect()}
    assert shares == {"small": 0.75, "large": 0.25}


def test_largest_names(schools, rows_of):
    assert rows_of(W.largest_names(schools, 1)) == [
        ("a", "large", 99.0, 109.0),
        ("a", "small", 10.0, 109.0),
    ]
