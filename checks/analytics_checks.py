"""Analytic queries: groupings, projections, ranks, union."""

from __future__ import annotations

from pyspark.sql import functions as F

from campusgrid.plans import analytics as A
from checks.registry import check
from checks.sql import (
    SIZE_POSITION,
    avg,
    inst,
    pct,
    rates,
    ratio,
    share,
    tally,
    trunc,
)
from checks.tables import institutions

SIZED = ("student_size", "size_category")
TIES = "school_name, school_state, school_id"
SHOWN = ("school_name", "school_state", "school_id")
MONEY = ("tuition_in_state", "tuition_out_of_state", "median_debt", "earnings_10yr_median")
PERCENT = ("admission_rate_percentage", "completion_rate_percentage")

SIZE_STATISTICS = f"""
  SELECT size_category, count(*) AS institution_count, sum(student_size) AS total_students,
    {avg("student_size", 6)} AS avg_students, min(student_size) AS min_students,
    max(student_size) AS max_students,
    {share("count(*)", "sum(count(*)) OVER ()")} AS pct_of_institutions
  FROM inst WHERE size_category IS NOT NULL GROUP BY size_category"""


#: By size, from large to small, anything else last.
BY_SIZE = (f"{SIZE_POSITION} ELSE 4 END", ("size_category",))


@check("a1_size_statistics", inst(SIZE_STATISTICS), BY_SIZE)
def _(spark, sf_dir):
    return A.size_statistics(institutions(spark, sf_dir, *SIZED))


def _state_admission_sql(least: int) -> str:
    return inst(f"""
      SELECT school_state, count(*) AS total_schools, count(admission_rate) AS schools_with_rate,
        {rates("admission_rate", "admission")}
      FROM inst GROUP BY school_state HAVING count(admission_rate) >= {least}""")


@check("a2_state_admission", _state_admission_sql(5))
def _(spark, sf_dir):
    return A.state_admission(institutions(spark, sf_dir, "school_state", "admission_rate"))


@check("a2_state_admission_large", _state_admission_sql(1500))
def _(spark, sf_dir):
    return A.state_admission(institutions(spark, sf_dir, "school_state", "admission_rate"), 1500)


@check(
    "a3_state_selectivity",
    inst(f"""
      SELECT school_state, count(*) AS institution_count,
        {pct(avg("admission_rate"))} AS avg_admission_rate_pct,
        CAST(rank() OVER (ORDER BY {avg("admission_rate")}) AS INTEGER) AS selectivity_rank,
        CASE WHEN {avg("admission_rate")} < 0.30 THEN 'Highly Selective'
          WHEN {avg("admission_rate")} < 0.50 THEN 'Selective'
          WHEN {avg("admission_rate")} < 0.70 THEN 'Moderately Selective'
          ELSE 'Open Admission' END AS selectivity_tier
      FROM inst WHERE admission_rate IS NOT NULL GROUP BY school_state HAVING count(*) >= 10"""),
)
def _(spark, sf_dir):
    return A.state_selectivity(institutions(spark, sf_dir, "school_state", "admission_rate"))


@check(
    "a4_state_size_admission",
    inst(f"""
      SELECT school_state, size_category, count(*) AS school_count,
        {pct(avg("admission_rate"))} AS avg_admission_rate_pct
      FROM inst WHERE admission_rate IS NOT NULL AND size_category IS NOT NULL
      GROUP BY school_state, size_category HAVING count(*) >= 300"""),
)
def _(spark, sf_dir):
    df = institutions(spark, sf_dir, "school_state", "size_category", "admission_rate")
    return A.state_size_admission(df, 300)


@check(
    "a5_size_distribution",
    inst(f"""
      SELECT coalesce(size_category, 'Unknown') AS size_category, count(*) AS institution_count,
        {share("count(*)", "sum(count(*)) OVER ()")} AS pct_of_total,
        sum(coalesce(student_size, 0)) AS total_enrollment,
        {avg("student_size", 6)} AS avg_enrollment,
        {avg("completion_rate_percentage", 6)} AS avg_completion_rate_pct,
        {avg("admission_rate_percentage", 6)} AS avg_admission_rate_pct
      FROM inst GROUP BY size_category"""),
    BY_SIZE,
)
def _(spark, sf_dir):
    df = A.size_distribution(institutions(spark, sf_dir, *SIZED, *PERCENT))
    return df.withColumns(
        {c: F.round(c, 6) for c in ("avg_completion_rate_pct", "avg_admission_rate_pct")}
    )


@check(
    "a6_state_sizes",
    inst(f"""
      SELECT school_state, {tally("size_category = 'small'")} AS small_schools,
        {tally("size_category = 'medium'")} AS medium_schools,
        {tally("size_category = 'large'")} AS large_schools, count(*) AS total_schools,
        {share(tally("size_category = 'large'"), "count(*)")} AS pct_large
      FROM inst GROUP BY school_state HAVING count(*) >= 2000"""),
)
def _(spark, sf_dir):
    return A.state_sizes(institutions(spark, sf_dir, "school_state", "size_category"), 2000)


@check(
    "a7_size_performance",
    inst(f"""
      SELECT size_category, count(*) AS school_count,
        {pct(avg("admission_rate"))} AS avg_admission_rate_pct,
        {pct(avg("completion_rate"))} AS avg_completion_rate_pct,
        {avg("tuition_in_state", 6)} AS avg_tuition_in_state,
        {avg("tuition_out_of_state", 6)} AS avg_tuition_out_of_state,
        {avg("median_debt", 6)} AS avg_median_debt,
        {avg("earnings_10yr_median", 6)} AS avg_10yr_earnings
      FROM inst WHERE size_category IS NOT NULL GROUP BY size_category"""),
)
def _(spark, sf_dir):
    return A.size_performance(
        institutions(spark, sf_dir, *SIZED, "admission_rate", "completion_rate", *MONEY)
    )


@check(
    "a8_overall_summary",
    inst(f"""
      SELECT count(*) AS total_institutions, count(DISTINCT school_state) AS states_covered,
        sum(student_size) AS total_enrollment,
        {pct(avg("admission_rate"))} AS avg_admission_rate_pct,
        {pct(avg("completion_rate"))} AS avg_completion_rate_pct,
        {trunc("tuition_in_state")} AS avg_in_state_tuition,
        {trunc("earnings_10yr_median")} AS avg_10yr_earnings
      FROM inst"""),
)
def _(spark, sf_dir):
    return A.overall_summary(
        institutions(
            spark,
            sf_dir,
            "school_state",
            "student_size",
            "admission_rate",
            "completion_rate",
            "tuition_in_state",
            "earnings_10yr_median",
        )
    )


@check(
    "a9_top_states",
    inst(f"""
      SELECT school_state, count(*) AS institution_count, sum(student_size) AS total_enrollment,
        {pct(avg("completion_rate"))} AS avg_completion_pct
      FROM inst GROUP BY school_state ORDER BY count(*) DESC, school_state LIMIT 10"""),
)
def _(spark, sf_dir):
    return A.top_states(
        institutions(spark, sf_dir, "school_state", "student_size", "completion_rate")
    )


@check(
    "a10_admissions_summary",
    inst(f"""
      SELECT school_state AS state_code, count(*) AS total_institutions,
        count(admission_rate) AS institutions_with_admission_data,
        round(count(admission_rate) * 100.0 / count(*), 6)::DOUBLE AS data_completeness_pct,
        {rates("admission_rate", "admission")},
        {tally("admission_rate < 0.25")} AS highly_selective_count,
        {tally("admission_rate >= 0.25 AND admission_rate < 0.50")} AS selective_count,
        {tally("admission_rate >= 0.50 AND admission_rate < 0.75")} AS moderately_selective_count,
        {tally("admission_rate >= 0.75")} AS open_admission_count,
        CASE WHEN {avg("admission_rate")} < 0.40 THEN 'Highly Competitive'
          WHEN {avg("admission_rate")} < 0.60 THEN 'Competitive'
          WHEN {avg("admission_rate")} < 0.80 THEN 'Moderately Competitive'
          ELSE 'Accessible' END AS state_selectivity_tier,
        sum(coalesce(student_size, 0)) AS total_enrollment,
        {avg("student_size", 6)} AS avg_enrollment_per_institution,
        {tally("size_category = 'small'")} AS small_institution_count,
        {tally("size_category = 'medium'")} AS medium_institution_count,
        {tally("size_category = 'large'")} AS large_institution_count,
        {trunc("tuition_in_state")} AS avg_in_state_tuition,
        {trunc("tuition_out_of_state")} AS avg_out_of_state_tuition,
        CAST(rank() OVER (ORDER BY {avg("admission_rate")} ASC NULLS FIRST) AS INTEGER)
          AS selectivity_rank
      FROM inst GROUP BY school_state"""),
)
def _(spark, sf_dir):
    return A.admissions_summary(
        institutions(
            spark,
            sf_dir,
            "school_state",
            "admission_rate",
            *SIZED,
            "tuition_in_state",
            "tuition_out_of_state",
        )
    )


PERFORMANCE = ("school_state", "completion_rate", "admission_rate", "student_size", *MONEY)
EARNINGS, DEBT = avg("earnings_10yr_median", 6), avg("median_debt", 6)
VALUE = (
    f"round({avg('completion_rate')} * 100 - coalesce({DEBT}, 0) / 1000"
    f" + coalesce({EARNINGS}, 0) / 1000, 6)"
)
STATE_PERFORMANCE = f"""
  SELECT school_state AS state_code, count(*) AS total_institutions,
    count(completion_rate) AS institutions_with_completion_data,
    {rates("completion_rate", "completion")},
    {tally("completion_rate >= 0.80")} AS excellent_completion_count,
    {tally("completion_rate >= 0.60 AND completion_rate < 0.80")} AS good_completion_count,
    {tally("completion_rate >= 0.40 AND completion_rate < 0.60")} AS moderate_completion_count,
    {tally("completion_rate < 0.40")} AS low_completion_count,
    CASE WHEN {avg("completion_rate")} >= 0.65 THEN 'Top Performing'
      WHEN {avg("completion_rate")} >= 0.50 THEN 'Above Average'
      WHEN {avg("completion_rate")} >= 0.40 THEN 'Average'
      ELSE 'Below Average' END AS state_performance_tier,
    {trunc("earnings_10yr_median")} AS avg_10yr_earnings,
    CAST(trunc(min(earnings_10yr_median)) AS INTEGER) AS min_10yr_earnings,
    CAST(trunc(max(earnings_10yr_median)) AS INTEGER) AS max_10yr_earnings,
    {trunc("tuition_in_state")} AS avg_tuition_in_state,
    {trunc("tuition_out_of_state")} AS avg_tuition_out_of_state,
    {trunc("median_debt")} AS avg_median_debt,
    {ratio(EARNINGS, DEBT)} AS earnings_to_debt_ratio,
    {ratio(EARNINGS, avg("tuition_in_state", 6))} AS earnings_to_tuition_ratio,
    sum(coalesce(student_size, 0)) AS total_enrollment,
    {avg("student_size", 6)} AS avg_institution_size,
    {pct(avg("admission_rate"))} AS avg_admission_rate_pct,
    CAST(CAST({VALUE} AS VARCHAR) AS DECIMAL(10,2)) AS value_score,
    CAST(rank() OVER (ORDER BY {avg("completion_rate")} DESC NULLS LAST) AS INTEGER)
      AS completion_rank,
    CAST(rank() OVER (ORDER BY {EARNINGS} DESC NULLS LAST) AS INTEGER) AS earnings_rank,
    CAST(rank() OVER (ORDER BY {DEBT} ASC NULLS FIRST) AS INTEGER) AS debt_rank_best_first
  FROM inst GROUP BY school_state"""


@check("a11_state_performance", inst(STATE_PERFORMANCE))
def _(spark, sf_dir):
    return A.state_performance(institutions(spark, sf_dir, *PERFORMANCE))


@check(
    "a12_size_category_analysis",
    inst(f"""
      SELECT coalesce(size_category, 'Unknown') AS size_category, count(*) AS institution_count,
        {share("count(*)", "sum(count(*)) OVER ()")} AS pct_of_total,
        sum(coalesce(student_size, 0)) AS total_enrollment,
        {avg("student_size", 6)} AS avg_enrollment,
        {pct(avg("admission_rate"))} AS avg_admission_rate_pct,
        {pct(avg("completion_rate"))} AS avg_completion_rate_pct,
        {trunc("tuition_in_state")} AS avg_tuition_in_state,
        {trunc("tuition_out_of_state")} AS avg_tuition_out_of_state,
        {trunc("median_debt")} AS avg_median_debt,
        {trunc("earnings_10yr_median")} AS avg_10yr_earnings,
        CAST({SIZE_POSITION} ELSE 4 END AS INTEGER) AS display_order
      FROM inst GROUP BY inst.size_category"""),
    ("display_order", ("size_category", "display_order")),
)
def _(spark, sf_dir):
    return A.size_category_analysis(
        institutions(spark, sf_dir, *SIZED, "admission_rate", "completion_rate", *MONEY)
    )


@check(
    "a13_state_overview",
    inst(f"""
      SELECT state_code, avg_completion_rate_pct, avg_10yr_earnings, value_score,
        state_performance_tier
      FROM ({STATE_PERFORMANCE}) WHERE total_institutions >= 2000"""),
)
def _(spark, sf_dir):
    return A.state_overview(institutions(spark, sf_dir, *PERFORMANCE), 2000)


# --- projections -----------------------------------------------------------


@check(
    "r1_high_performers",
    inst("""
      SELECT school_name, school_state, completion_rate_percentage, admission_rate_percentage,
        student_size, earnings_10yr_median,
        CASE WHEN completion_rate >= 0.90 THEN 'Elite (90%+)'
          WHEN completion_rate >= 0.80 THEN 'Excellent (80-90%)' ELSE 'Other' END
          AS performance_tier
      FROM inst WHERE completion_rate >= 0.80"""),
)
def _(spark, sf_dir):
    return A.high_performers(
        institutions(
            spark,
            sf_dir,
            *SHOWN,
            "completion_rate",
            *PERCENT,
            "student_size",
            "earnings_10yr_median",
        )
    )


@check(
    "r2_admission_completion_profile",
    inst("""
      SELECT school_name, school_state, admission_rate_percentage, completion_rate_percentage,
        student_size,
        CASE WHEN admission_rate < 0.30 AND completion_rate > 0.80 THEN 'Selective + High Completion'
          WHEN admission_rate >= 0.70 AND completion_rate > 0.70 THEN 'Open + High Completion'
          WHEN admission_rate < 0.30 AND completion_rate < 0.50 THEN 'Selective + Low Completion'
          WHEN admission_rate >= 0.70 AND completion_rate < 0.40 THEN 'Open + Low Completion'
          ELSE 'Average' END AS admission_completion_profile
      FROM inst WHERE admission_rate IS NOT NULL AND completion_rate IS NOT NULL"""),
    (
        """CASE admission_completion_profile WHEN 'Selective + High Completion' THEN 1
          WHEN 'Open + High Completion' THEN 2 ELSE 3 END, completion_rate_percentage DESC""",
        ("completion_rate_percentage",),
    ),
)
def _(spark, sf_dir):
    return A.admission_completion_profile(
        institutions(
            spark, sf_dir, *SHOWN, "admission_rate", "completion_rate", *PERCENT, "student_size"
        )
    )


DETAIL = f"""
  SELECT school_id, school_name, school_city, school_state, school_zip, school_url, latitude,
    longitude, student_size, grad_students, size_category,
    coalesce(size_category, 'Unknown') AS size_category_display, admission_rate,
    coalesce(admission_rate_percentage, 0) AS admission_rate_pct,
    CASE WHEN admission_rate < 0.25 THEN 'Highly Selective (<25%)'
      WHEN admission_rate < 0.50 THEN 'Selective (25-50%)'
      WHEN admission_rate < 0.75 THEN 'Moderately Selective (50-75%)'
      WHEN admission_rate IS NOT NULL THEN 'Open Admission (75%+)' ELSE 'No Data' END
      AS selectivity_tier,
    completion_rate, completion_rate_4yr,
    coalesce(completion_rate_percentage, 0) AS completion_rate_pct,
    CASE WHEN completion_rate >= 0.80 THEN 'Excellent (80%+)'
      WHEN completion_rate >= 0.60 THEN 'Good (60-80%)'
      WHEN completion_rate >= 0.40 THEN 'Moderate (40-60%)'
      WHEN completion_rate IS NOT NULL THEN 'Low (<40%)' ELSE 'No Data' END AS completion_tier,
    tuition_in_state, tuition_out_of_state, median_debt, earnings_10yr_median,
    {ratio("earnings_10yr_median", "median_debt")} AS earnings_to_debt_ratio,
    ownership, region_id, locale, operating, extracted_at, source
  FROM inst"""


@check("r3_institution_detail", inst(DETAIL))
def _(spark, sf_dir):
    return A.institution_detail(institutions(spark, sf_dir))


@check(
    "r4_institution_search",
    inst(f"""
      SELECT school_name, school_state, selectivity_tier, completion_tier, tuition_in_state,
        earnings_10yr_median
      FROM ({DETAIL}) WHERE size_category = 'large' AND admission_rate_pct BETWEEN 40 AND 70"""),
)
def _(spark, sf_dir):
    return A.institution_search(institutions(spark, sf_dir))


LISTED = ("school_id", "school_name", "school_state", "student_size", "size_category")
LISTED_SQL = ", ".join(LISTED)


@check("r5_by_state", inst(f"SELECT {LISTED_SQL} FROM inst WHERE school_state = 'NATION_7'"))
def _(spark, sf_dir):
    return A.in_state(institutions(spark, sf_dir, *LISTED), "NATION_7")


@check("r5_by_size", inst(f"SELECT {LISTED_SQL} FROM inst WHERE size_category = 'large'"))
def _(spark, sf_dir):
    return A.in_size_class(institutions(spark, sf_dir, *LISTED), "large")


@check(
    "r5_highly_selective",
    inst(f"SELECT {LISTED_SQL}, admission_rate FROM inst WHERE admission_rate < 0.25"),
)
def _(spark, sf_dir):
    return A.highly_selective(institutions(spark, sf_dir, *LISTED, "admission_rate"))


@check(
    "r5_top_performers",
    inst(f"SELECT {LISTED_SQL}, completion_rate FROM inst WHERE completion_rate > 0.80"),
)
def _(spark, sf_dir):
    return A.top_performers(institutions(spark, sf_dir, *LISTED, "completion_rate"))


# --- ranks, top n, union ---------------------------------------------------


@check(
    "w1_largest_schools",
    inst(f"""
      SELECT school_name, school_state, school_city, student_size, size_category,
        admission_rate_percentage, completion_rate_percentage, tuition_in_state,
        tuition_out_of_state,
        CAST(rank() OVER (ORDER BY student_size DESC) AS INTEGER) AS size_rank
      FROM inst WHERE student_size IS NOT NULL
      ORDER BY student_size DESC, {TIES} LIMIT 25"""),
)
def _(spark, sf_dir):
    return A.largest_schools(
        institutions(
            spark,
            sf_dir,
            *SHOWN,
            "school_city",
            *SIZED,
            *PERCENT,
            "tuition_in_state",
            "tuition_out_of_state",
        )
    )


@check(
    "w2_largest_per_state",
    inst(f"""
      SELECT school_state, school_name, student_size, size_category, admission_rate_percentage,
        completion_rate_percentage
      FROM inst WHERE student_size IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY school_state
        ORDER BY student_size DESC, {TIES}) = 1"""),
)
def _(spark, sf_dir):
    return A.largest_per_state(institutions(spark, sf_dir, *SHOWN, *SIZED, *PERCENT))




@check(
    "w3_best_completion",
    inst(f"""
      SELECT school_name, school_state, school_city, completion_rate_percentage,
        admission_rate_percentage, student_size, size_category, tuition_in_state,
        earnings_10yr_median,
        CAST(rank() OVER (ORDER BY completion_rate DESC) AS INTEGER) AS completion_rank
      FROM inst WHERE completion_rate IS NOT NULL
      ORDER BY completion_rate DESC, {TIES} LIMIT 50"""),
)
def _(spark, sf_dir):
    return A.best_completion(
        institutions(
            spark,
            sf_dir,
            *SHOWN,
            "school_city",
            "completion_rate",
            *PERCENT,
            *SIZED,
            "tuition_in_state",
            "earnings_10yr_median",
        )
    )


@check(
    "u1_data_quality_metrics",
    inst("""
      SELECT 'Total Records' AS metric, CAST(count(*) AS VARCHAR) AS value FROM inst
      UNION ALL SELECT 'Records with Admission Rate', CAST(count(admission_rate) AS VARCHAR)
        FROM inst
      UNION ALL SELECT 'Records with Completion Rate', CAST(count(completion_rate) AS VARCHAR)
        FROM inst
      UNION ALL SELECT 'Records with Student Size', CAST(count(student_size) AS VARCHAR) FROM inst
      UNION ALL SELECT 'Records with Size Category', CAST(count(size_category) AS VARCHAR)
        FROM inst"""),
)
def _(spark, sf_dir):
    return A.data_quality_metrics(
        institutions(spark, sf_dir, *SIZED, "admission_rate", "completion_rate")
    )
