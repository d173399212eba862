"""What the physical plans must and must not contain."""

from __future__ import annotations

import contextlib
import io

import pytest

from campusgrid.operators import quality as Q
from campusgrid.operators import snapshots as S
from campusgrid.plans import analytics as A
from checks import load_all
from checks.registry import ORACLES, QUERIES
from checks.tables import institutions, raw_records, surveys
from campusgrid.operators.joins import merge_surveys, merge_unique_surveys

SF = "/root/testdata/sf0.001"

load_all()


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


EAGER = ("l", "k", "s2_", "s9", "s14", "s15", "v13")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(EAGER)])
def test_no_cross_join_and_no_row_function(no_broadcast, name):
    text = plan(QUERIES[name](no_broadcast, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in text


def test_filter_and_columns_reach_the_scan(spark, tmp_path):
    institutions(spark, SF).write.parquet(str(tmp_path / "institutions"))
    df = spark.read.parquet(str(tmp_path / "institutions"))
    text = plan(A.in_state(df, "NATION_7").select("school_id"))
    assert "EqualTo(school_state,NATION_7)" in text
    assert "ReadSchema: struct<school_id:bigint,school_state:string>" in text
    text = plan(A.state_admission(df))
    assert "ReadSchema: struct<school_state:string,admission_rate:double>" in text
    text = plan(A.high_performers(df))
    assert "GreaterThanOrEqual(completion_rate,0.8)" in text


def test_top_n_is_taken_before_the_rank(spark):
    text = plan(A.largest_schools(institutions(spark, SF)))
    assert text.index("Window [rank") < text.index("TakeOrderedAndProject")
    assert "Exchange SinglePartition" not in text.split("TakeOrderedAndProject")[1]


@pytest.mark.parametrize("keep", ["first", "last"])
def test_duplicates_shrink_before_the_shuffle(spark, keep):
    text = plan(Q.deduplicate(raw_records(spark, SF), keep=keep))
    assert text.count("WindowGroupLimit") == 2


def test_largest_per_state_shrinks_before_the_shuffle(spark):
    assert plan(A.largest_per_state(institutions(spark, SF))).count("WindowGroupLimit") == 2


def test_report_shuffles_two_counts_per_key(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr(
        "l_shipdate AS school_name",
        "l_returnflag AS school_state",
        "l_quantity AS student_size",
        "l_tax AS admission_rate_overall",
        "l_discount AS completion_rate_overall",
    )
    text = plan(Q.validation_report(df))
    assert text.count("FileScan") == 2
    assert text.count("Exchange hashpartitioning") == 1
    below = text[text.index("Exchange hashpartitioning") :]
    assert below.split("partial_count", 1)[1].split("\n")[0].count("partial_count") == 1


def test_metrics_are_one_scan(spark):
    df = institutions(spark, SF, "size_category", "student_size", "admission_rate", "completion_rate")
    assert plan(A.data_quality_metrics(df)).count("FileScan") == 1


def test_survey_chain_shuffles_each_survey_once(no_broadcast):
    df = merge_surveys(surveys(no_broadcast, SF))
    text = plan(df)
    assert text.count("SortMergeJoin") == 3
    assert "FullOuter" not in text
    assert "Generate" not in text  # no key is hot, so nothing is dealt
    # Each survey is read once, and its key once more in the plan of the counts.
    names = ("HD_INSTNM", "IC_TUITION2", "EFFY_EFYTOTLT", "SFA_SCUGRAD")
    assert text.count("FileScan") == 4 + 4 * len(names)
    # The counts per key are used four times and made once: their stage, one stage per
    # survey, the joins.
    context = no_broadcast.sparkContext
    context.setJobGroup("chain", "survey chain")
    df.collect()
    tracker = context.statusTracker()
    stages = {
        stage
        for job in tracker.getJobIdsForGroup("chain")
        for stage in tracker.getJobInfo(job).stageIds
        if tracker.getStageInfo(stage) and tracker.getStageInfo(stage).numCompletedTasks
    }
    assert len(stages) <= 7


def test_unique_surveys_need_one_shuffle(no_broadcast):
    text = plan(merge_unique_surveys(surveys(no_broadcast, SF)))
    assert text.count("Exchange hashpartitioning") == 1
    assert "Join" not in text


def test_newest_versions_are_counted_not_sorted(spark):
    df = spark.createDataFrame([("s", "d", "v")], "source string, dataset string, version string")
    # The only window over rows of versions themselves is that within one second.
    text = plan(S.nth_newest(df, 5))
    assert "row_number" not in text and "rank(" not in text


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
