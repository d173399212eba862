from __future__ import annotations

from decimal import Decimal
from statistics import stdev

import pytest

from campusgrid.operators.clean import derive
from campusgrid.plans import analytics as A
from campusgrid.schema import INSTITUTION


@pytest.fixture
def table(spark):
    """Institutions from (name, state, size, admission, completion, debt, earnings) rows."""

    def make(rows):
        filled = [
            {
                "school_id": i,
                "school_name": name,
                "school_state": state,
                "student_size": None if size is None else float(size),
                "admission_rate": admission,
                "completion_rate": completion,
                "median_debt": debt,
                "earnings_10yr_median": earnings,
                "tuition_in_state": 1000.0,
            }
            for i, (name, state, size, admission, completion, debt, earnings) in enumerate(rows)
        ]
        values = [tuple(r.get(c) for c in INSTITUTION.names) for r in filled]
        return derive(spark.createDataFrame(values, INSTITUTION)).select(*INSTITUTION.names)

    return make


@pytest.fixture
def alabama(table):
    return table(
        [
            ("Alabama A & M University", "AL", 6207, 0.8209, 0.2912, 15250.0, 40628.0),
            ("University of Alabama at Birmingham", "AL", 13856, 0.8073, 0.5885, 15085.0, 54501.0),
            ("University of Alabama in Huntsville", "AL", 7249, 0.7828, 0.4891, 14000.0, 61767.0),
            ("Alabama State University", "AL", 4006, 0.9787, 0.2748, 17500.0, 34502.0),
            ("The University of Alabama", "AL", 32580, 0.8025, 0.7206, 17671.0, 59221.0),
        ]
    )


def test_size_classes(alabama):
    rows = {r.school_name: r.size_category for r in alabama.collect()}
    assert rows["Alabama State University"] == "small"
    assert rows["The University of Alabama"] == "large"
    assert list(rows.values()).count("medium") == 3


def test_state_admission(alabama):
    row = A.state_admission(alabama).first()
    assert (row.total_schools, row.schools_with_rate) == (5, 5)
    assert row.avg_admission_rate_pct == Decimal("83.84")
    assert (row.min_admission_rate_pct, row.max_admission_rate_pct) == (
        Decimal("78.28"),
        Decimal("97.87"),
    )
    rates = [0.8209, 0.8073, 0.7828, 0.9787, 0.8025]
    assert float(row.stddev_admission_rate_pct) == round(stdev(rates) * 100, 2)
    assert A.state_admission(alabama, 6).count() == 0


def test_largest(alabama):
    rows = A.largest_schools(alabama, 2).collect()
    assert [(r.school_name, r.size_rank) for r in rows] == [
        ("The University of Alabama", 1),
        ("University of Alabama at Birmingham", 2),
    ]
    assert A.largest_per_state(alabama).first().school_name == "The University of Alabama"


def test_state_without_admission_data(table):
    df = table(
        [
            ("a", "NO", 10, None, None, 0.0, 100.0),
            ("b", "OK", 10, 0.2, 0.9, 10.0, 100.0),
            ("c", "OK", 10, 0.4, 0.7, 10.0, 100.0),
        ]
    )
    rows = {r.state_code: r for r in A.admissions_summary(df).collect()}
    assert rows["NO"].avg_admission_rate_pct is None
    assert rows["NO"].state_selectivity_tier == "Accessible"
    assert (rows["NO"].selectivity_rank, rows["OK"].selectivity_rank) == (1, 2)
    assert (rows["NO"].data_completeness_pct, rows["OK"].data_completeness_pct) == (0.0, 100.0)
    assert A.state_selectivity(df, 1).count() == 1
    assert A.state_admission(df, 1).count() == 1
    performance = {r.state_code: r for r in A.state_performance(df).collect()}
    assert performance["NO"].state_performance_tier == "Below Average"
    assert performance["NO"].earnings_to_debt_ratio is None
    assert performance["NO"].value_score is None
    assert performance["OK"].earnings_to_debt_ratio == Decimal("10.00")
    assert performance["OK"].value_score == Decimal("80.09")
    assert (performance["OK"].completion_rank, performance["NO"].completion_rank) == (1, 2)
    assert (performance["NO"].debt_rank_best_first, performance["OK"].debt_rank_best_first) == (1, 2)


def test_detail_edges(table):
    df = table(
        [
            ("a", "X", None, None, None, 0.0, 5.0),
            ("b", "X", 20000, 0.25, 0.8, 3.0, 10.0),
            ("c", "X", 20000, 0.55, 0.3999, None, 10.0),
        ]
    )
    rows = {r.school_name: r for r in A.institution_detail(df).collect()}
    assert len(A.institution_detail(df).columns) == 30
    assert (rows["a"].selectivity_tier, rows["a"].completion_tier) == ("No Data", "No Data")
    assert (rows["a"].admission_rate_pct, rows["a"].size_category_display) == (0.0, "Unknown")
    assert rows["a"].earnings_to_debt_ratio is None
    assert rows["b"].selectivity_tier == "Selective (25-50%)"
    assert rows["b"].completion_tier == "Excellent (80%+)"
    assert rows["b"].earnings_to_debt_ratio == Decimal("3.33")
    assert rows["c"].completion_tier == "Low (<40%)"
    found = A.institution_search(df).collect()
    assert [r.school_name for r in found] == ["c"]


def test_rank_under_limit_counts_ties(table):
    df = table([(n, "X", s, None, None, None, None) for n, s in zip("abcd", (5, 9, 9, 7))])
    rows = A.largest_schools(df, 3).collect()
    assert [(r.school_name, r.size_rank) for r in rows] == [("b", 1), ("c", 1), ("d", 3)]


def test_size_distribution_names_the_unknown_class(table):
    df = table([("a", "X", None, 0.5, 0.5, None, None), ("b", "X", 1, 0.5, 0.5, None, None)])
    rows = A.size_distribution(df).collect()
    assert [(r.size_category, r.institution_count, r.pct_of_total) for r in rows] == [
        ("small", 1, Decimal("50.00")),
        ("Unknown", 1, Decimal("50.00")),
    ]
    assert [r.display_order for r in A.size_category_analysis(df).collect()] == [3, 4]


def test_metrics(alabama):
    rows = {r.metric: r.value for r in A.data_quality_metrics(alabama).collect()}
    assert rows["Total Records"] == "5" and len(rows) == 5


def test_views(spark, alabama):
    A.register_views(alabama)
    count = spark.sql("SELECT count(*) AS n FROM institution_detail WHERE admission_rate_pct > 80")
    assert count.first().n == 4
    rows = spark.sql("SELECT size_category FROM size_category_analysis ORDER BY display_order")
    assert [r[0] for r in rows.collect()] == ["large", "medium", "small"]


def test_empty_table(table, spark):
    df = spark.createDataFrame([], INSTITUTION)
    assert A.overall_summary(df).first().total_institutions == 0
    for query in (A.largest_schools, A.state_performance, A.size_distribution, A.top_states):
        assert query(df).count() == 0
