"""Analytic queries over the institution table (`schema.INSTITUTION`).

Every query is one grouping, one top-n or one projection. Ranks and shares run
over grouped rows, so their single partition holds tens of rows. Sorted results
end their order with unique columns: that makes them repeatable, and it gives a
distributed sort enough distinct values when a third of the rows tie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campusgrid.functions import classes as K
from campusgrid.functions.numbers import (
    as_percent,
    ratio,
    share_of,
    steady_avg,
    whole_part,
)

TIES = ("school_name", "school_state", "school_id")


def _rows() -> Column:
    return F.count(F.lit(1))


def _money(column: str) -> Column:
    return steady_avg(F.col(column), 6)


def _size(category: str) -> Column:
    return F.count_if(F.col("size_category") == category)


def _over_all():
    """All rows of a grouped result."""
    return Window.partitionBy()


def _rates(column: Column, prefix: str) -> list[Column]:
    """Average, minimum, maximum and sample deviation of a rate, in percent."""
    return [
        as_percent(steady_avg(column)).alias(f"avg_{prefix}_rate_pct"),
        as_percent(F.min(column)).alias(f"min_{prefix}_rate_pct"),
        as_percent(F.max(column)).alias(f"max_{prefix}_rate_pct"),
        as_percent(F.stddev_samp(column)).alias(f"stddev_{prefix}_rate_pct"),
    ]


# --- largest institutions --------------------------------------------------


def largest_schools(df: DataFrame, n: int = 25) -> DataFrame:
    """The n largest with their rank.

    The rank of a row depends only on rows above it, so the n rows are taken
    first and ranked then; the other way round would sort the whole table in
    one partition.
    """
    top = (
        df.filter(F.col("student_size").isNotNull())
        .select(
            "school_name",
            "school_state",
            "school_city",
            "student_size",
            "size_category",
            "admission_rate_percentage",
            "completion_rate_percentage",
            "tuition_in_state",
            "tuition_out_of_state",
            "school_id",
        )
        .orderBy(F.desc("student_size"), *TIES)
        .limit(n)
    )
    rank = F.rank().over(_over_all().orderBy(F.desc("student_size")))
    return top.withColumn("size_rank", rank).orderBy("size_rank", *TIES).drop("school_id")


def largest_per_state(df: DataFrame) -> DataFrame:
    """The largest institution of each state, ties by name and id."""
    window = Window.partitionBy("school_state").orderBy(F.desc("student_size"), *TIES)
    return (
        df.filter(F.col("student_size").isNotNull())
        .select(
            "school_state",
            "school_name",
            "student_size",
            "size_category",
            "admission_rate_percentage",
            "completion_rate_percentage",
            "school_id",
        )
        .withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .orderBy(F.desc("student_size"), *TIES)
        .drop("_rank", "school_id")
    )


def size_statistics(df: DataFrame) -> DataFrame:
    grouped = (
        df.filter(F.col("size_category").isNotNull())
        .groupBy("size_category")
        .agg(
            _rows().alias("institution_count"),
            F.sum("student_size").alias("total_students"),
            steady_avg(F.col("student_size"), 6).alias("avg_students"),
            F.min("student_size").alias("min_students"),
            F.max("student_size").alias("max_students"),
        )
    )
    whole = F.sum("institution_count").over(_over_all())
    return grouped.withColumn(
        "pct_of_institutions", share_of(F.col("institution_count"), whole)
    ).orderBy(K.size_position(F.col("size_category")))


# --- admission by state ----------------------------------------------------


def state_admission(df: DataFrame, min_rates: int = 5) -> DataFrame:
    """Admission statistics of states with enough known rates, most selective first."""
    return (
        df.groupBy("school_state")
        .agg(
            _rows().alias("total_schools"),
            F.count(F.col("admission_rate")).alias("schools_with_rate"),
            *_rates(F.col("admission_rate"), "admission"),
            steady_avg(F.col("admission_rate")).alias("_avg"),
        )
        .filter(F.col("schools_with_rate") >= min_rates)
        .orderBy("_avg", "school_state")
        .drop("_avg")
    )


def state_selectivity(df: DataFrame, min_schools: int = 10) -> DataFrame:
    """States ranked by average admission rate, with their tier."""
    grouped = (
        df.filter(F.col("admission_rate").isNotNull())
        .groupBy("school_state")
        .agg(_rows().alias("institution_count"), steady_avg(F.col("admission_rate")).alias("_avg"))
        .filter(F.col("institution_count") >= min_schools)
    )
    tier = K.below(F.col("_avg"), K.STATE_SELECTIVITY, K.STATE_SELECTIVITY_REST)
    return grouped.select(
        "school_state",
        "institution_count",
        as_percent(F.col("_avg")).alias("avg_admission_rate_pct"),
        F.rank().over(_over_all().orderBy(F.asc("_avg"))).alias("selectivity_rank"),
        tier.alias("selectivity_tier"),
    ).orderBy("selectivity_rank", "school_state")


def state_size_admission(df: DataFrame, min_schools: int = 3) -> DataFrame:
    return (
        df.filter(F.col("admission_rate").isNotNull() & F.col("size_category").isNotNull())
        .groupBy("school_state", "size_category")
        .agg(
            _rows().alias("school_count"),
            as_percent(steady_avg(F.col("admission_rate"))).alias("avg_admission_rate_pct"),
        )
        .filter(F.col("school_count") >= min_schools)
        .orderBy("school_state", K.size_position(F.col("size_category")))
    )


# --- completion ------------------------------------------------------------


def best_completion(df: DataFrame, n: int = 50) -> DataFrame:
    """The n highest completion rates with their rank (taken first, ranked then)."""
    top = (
        df.filter(F.col("completion_rate").isNotNull())
        .select(
            "school_name",
            "school_state",
            "school_city",
            "completion_rate_percentage",
            "admission_rate_percentage",
            "student_size",
            "size_category",
            "tuition_in_state",
            "earnings_10yr_median",
            "completion_rate",
            "school_id",
        )
        .orderBy(F.desc("completion_rate"), *TIES)
        .limit(n)
    )
    rank = F.rank().over(_over_all().orderBy(F.desc("completion_rate")))
    return (
        top.withColumn("completion_rank", rank)
        .orderBy("completion_rank", *TIES)
        .drop("completion_rate", "school_id")
    )


def high_performers(df: DataFrame, min_rate: float = 0.80) -> DataFrame:
    tier = K.at_least(F.col("completion_rate"), K.HIGH_PERFORMERS, K.HIGH_PERFORMERS_REST)
    return (
        df.filter(F.col("completion_rate") >= min_rate)
        .orderBy(F.desc("completion_rate"), *TIES)
        .select(
            "school_name",
            "school_state",
            "completion_rate_percentage",
            "admission_rate_percentage",
            "student_size",
            "earnings_10yr_median",
            tier.alias("performance_tier"),
        )
    )


def admission_completion_profile(df: DataFrame) -> DataFrame:
    profile = K.rate_profile(F.col("admission_rate"), F.col("completion_rate"))
    return (
        df.filter(F.col("admission_rate").isNotNull() & F.col("completion_rate").isNotNull())
        .withColumn("admission_completion_profile", profile)
        .orderBy(
            K.profile_position(F.col("admission_completion_profile")),
            F.desc("completion_rate"),
            *TIES,
        )
        .select(
            "school_name",
            "school_state",
            "admission_rate_percentage",
            "completion_rate_percentage",
            "student_size",
            "admission_completion_profile",
        )
    )


# --- size classes ----------------------------------------------------------


def _named_size(column: str = "size_category") -> Column:
    return F.coalesce(F.col(column), F.lit("Unknown"))


def size_distribution(df: DataFrame) -> DataFrame:
    """Size classes with the unknown one, their share and averages."""
    grouped = df.groupBy("size_category").agg(
        _rows().alias("institution_count"),
        F.sum(F.coalesce("student_size", F.lit(0))).alias("total_enrollment"),
        steady_avg(F.col("student_size"), 6).alias("avg_enrollment"),
        F.avg("completion_rate_percentage").alias("avg_completion_rate_pct"),
        F.avg("admission_rate_percentage").alias("avg_admission_rate_pct"),
    )
    whole = F.sum("institution_count").over(_over_all())
    return grouped.orderBy(K.size_position(F.col("size_category"))).select(
        _named_size().alias("size_category"),
        "institution_count",
        share_of(F.col("institution_count"), whole).alias("pct_of_total"),
        "total_enrollment",
        "avg_enrollment",
        "avg_completion_rate_pct",
        "avg_admission_rate_pct",
    )


def state_sizes(df: DataFrame, min_schools: int = 20) -> DataFrame:
    """Schools per state and size class, one column per class."""
    return (
        df.groupBy("school_state")
        .agg(
            _size("small").alias("small_schools"),
            _size("medium").alias("medium_schools"),
            _size("large").alias("large_schools"),
            _rows().alias("total_schools"),
        )
        .filter(F.col("total_schools") >= min_schools)
        .withColumn("pct_large", share_of(F.col("large_schools"), F.col("total_schools")))
        .orderBy(F.desc("large_schools"), "school_state")
    )


def size_performance(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("size_category").isNotNull())
        .groupBy("size_category")
        .agg(
            _rows().alias("school_count"),
            as_percent(steady_avg(F.col("admission_rate"))).alias("avg_admission_rate_pct"),
            as_percent(steady_avg(F.col("completion_rate"))).alias("avg_completion_rate_pct"),
            _money("tuition_in_state").alias("avg_tuition_in_state"),
            _money("tuition_out_of_state").alias("avg_tuition_out_of_state"),
            _money("median_debt").alias("avg_median_debt"),
            _money("earnings_10yr_median").alias("avg_10yr_earnings"),
        )
        .orderBy(K.size_position(F.col("size_category")))
    )


# --- summaries -------------------------------------------------------------


def overall_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        _rows().alias("total_institutions"),
        F.countDistinct("school_state").alias("states_covered"),
        F.sum("student_size").alias("total_enrollment"),
        as_percent(steady_avg(F.col("admission_rate"))).alias("avg_admission_rate_pct"),
        as_percent(steady_avg(F.col("completion_rate"))).alias("avg_completion_rate_pct"),
        whole_part(_money("tuition_in_state")).alias("avg_in_state_tuition"),
        whole_part(_money("earnings_10yr_median")).alias("avg_10yr_earnings"),
    )


def top_states(df: DataFrame, n: int = 10) -> DataFrame:
    """The n states with the most institutions."""
    return (
        df.groupBy("school_state")
        .agg(
            _rows().alias("institution_count"),
            F.sum("student_size").alias("total_enrollment"),
            as_percent(steady_avg(F.col("completion_rate"))).alias("avg_completion_pct"),
        )
        .orderBy(F.desc("institution_count"), "school_state")
        .limit(n)
    )


def data_quality_metrics(df: DataFrame) -> DataFrame:
    """Five counts as (metric, value as text), from one scan."""
    counts = {
        "Total Records": _rows(),
        "Records with Admission Rate": F.count("admission_rate"),
        "Records with Completion Rate": F.count("completion_rate"),
        "Records with Student Size": F.count("student_size"),
        "Records with Size Category": F.count("size_category"),
    }
    wide = df.agg(*[c.cast("string").alias(name) for name, c in counts.items()])
    return wide.unpivot([], list(counts), "metric", "value")


# --- views -----------------------------------------------------------------


def admissions_summary(df: DataFrame) -> DataFrame:
    """Admission view: one row per state."""
    avg = steady_avg(F.col("admission_rate"))
    grouped = df.groupBy(F.col("school_state").alias("state_code")).agg(
        _rows().alias("total_institutions"),
        F.count(F.col("admission_rate")).alias("institutions_with_admission_data"),
        *_rates(F.col("admission_rate"), "admission"),
        F.count_if(F.col("admission_rate") < 0.25).alias("highly_selective_count"),
        F.count_if((F.col("admission_rate") >= 0.25) & (F.col("admission_rate") < 0.50)).alias("selective_count"),
        F.count_if((F.col("admission_rate") >= 0.50) & (F.col("admission_rate") < 0.75)).alias("moderately_selective_count"),
        F.count_if(F.col("admission_rate") >= 0.75).alias("open_admission_count"),
        K.below(avg, K.STATE_COMPETITION, K.STATE_COMPETITION_REST).alias("state_selectivity_tier"),
        F.sum(F.coalesce("student_size", F.lit(0))).alias("total_enrollment"),
        steady_avg(F.col("student_size"), 6).alias("avg_enrollment_per_institution"),
        _size("small").alias("small_institution_count"),
        _size("medium").alias("medium_institution_count"),
        _size("large").alias("large_institution_count"),
        whole_part(_money("tuition_in_state")).alias("avg_in_state_tuition"),
        whole_part(_money("tuition_out_of_state")).alias("avg_out_of_state_tuition"),
        avg.alias("_avg"),
    )
    completeness = (
        F.col("institutions_with_admission_data") * F.lit(100.0) / F.col("total_institutions")
    )
    return (
        grouped.withColumn("data_completeness_pct", F.round(completeness, 6))
        .withColumn("selectivity_rank", F.rank().over(_over_all().orderBy(F.asc("_avg"))))
        .drop("_avg")
    )


def state_performance(df: DataFrame) -> DataFrame:
    """Performance view: one row per state."""
    avg = steady_avg(F.col("completion_rate"))
    earnings, debt = _money("earnings_10yr_median"), _money("median_debt")
    tuition = _money("tuition_in_state")
    value = (
        avg * 100
        - F.coalesce(debt, F.lit(0)) / 1000
        + F.coalesce(earnings, F.lit(0)) / 1000
    )
    grouped = df.groupBy(F.col("school_state").alias("state_code")).agg(
        _rows().alias("total_institutions"),
        F.count(F.col("completion_rate")).alias("institutions_with_completion_data"),
        *_rates(F.col("completion_rate"), "completion"),
        F.count_if(F.col("completion_rate") >= 0.80).alias("excellent_completion_count"),
        F.count_if((F.col("completion_rate") >= 0.60) & (F.col("completion_rate") < 0.80)).alias("good_completion_count"),
        F.count_if((F.col("completion_rate") >= 0.40) & (F.col("completion_rate") < 0.60)).alias("moderate_completion_count"),
        F.count_if(F.col("completion_rate") < 0.40).alias("low_completion_count"),
        K.at_least(avg, K.STATE_PERFORMANCE, K.STATE_PERFORMANCE_REST).alias(
            "state_performance_tier"
        ),
        whole_part(earnings).alias("avg_10yr_earnings"),
        whole_part(F.min("earnings_10yr_median")).alias("min_10yr_earnings"),
        whole_part(F.max("earnings_10yr_median")).alias("max_10yr_earnings"),
        whole_part(tuition).alias("avg_tuition_in_state"),
        whole_part(_money("tuition_out_of_state")).alias("avg_tuition_out_of_state"),
        whole_part(debt).alias("avg_median_debt"),
        ratio(earnings, debt).alias("earnings_to_debt_ratio"),
        ratio(earnings, tuition).alias("earnings_to_tuition_ratio"),
        F.sum(F.coalesce("student_size", F.lit(0))).alias("total_enrollment"),
        steady_avg(F.col("student_size"), 6).alias("avg_institution_size"),
        as_percent(steady_avg(F.col("admission_rate"))).alias("avg_admission_rate_pct"),
        F.round(value, 6).cast("decimal(10,2)").alias("value_score"),
        avg.alias("_completion"),
        earnings.alias("_earnings"),
        debt.alias("_debt"),
    )
    ranks = {
        "completion_rank": F.desc("_completion"),
        "earnings_rank": F.desc("_earnings"),
        "debt_rank_best_first": F.asc("_debt"),
    }
    return grouped.withColumns(
        {name: F.rank().over(_over_all().orderBy(order)) for name, order in ranks.items()}
    ).drop("_completion", "_earnings", "_debt")


def institution_detail(df: DataFrame) -> DataFrame:
    """Detail view: one row per institution, 30 columns."""
    selectivity = K.below(F.col("admission_rate"), K.SCHOOL_SELECTIVITY, K.SCHOOL_SELECTIVITY_REST)
    completion = K.at_least(F.col("completion_rate"), K.SCHOOL_COMPLETION, K.SCHOOL_COMPLETION_REST)
    return df.select(
        "school_id",
        "school_name",
        "school_city",
        "school_state",
        "school_zip",
        "school_url",
        "latitude",
        "longitude",
        "student_size",
        "grad_students",
        "size_category",
        _named_size().alias("size_category_display"),
        "admission_rate",
        F.coalesce("admission_rate_percentage", F.lit(0.0)).alias("admission_rate_pct"),
        F.when(F.col("admission_rate").isNull(), K.NO_DATA).otherwise(selectivity).alias("selectivity_tier"),
        "completion_rate",
        "completion_rate_4yr",
        F.coalesce("completion_rate_percentage", F.lit(0.0)).alias("completion_rate_pct"),
        F.when(F.col("completion_rate").isNull(), K.NO_DATA).otherwise(completion).alias("completion_tier"),
        "tuition_in_state",
        "tuition_out_of_state",
        "median_debt",
        "earnings_10yr_median",
        ratio(F.col("earnings_10yr_median"), F.col("median_debt")).alias("earnings_to_debt_ratio"),
        "ownership",
        "region_id",
        "locale",
        "operating",
        "extracted_at",
        "source",
    )


def size_category_analysis(df: DataFrame) -> DataFrame:
    """Size class view with the display order."""
    grouped = df.groupBy("size_category").agg(
        _rows().alias("institution_count"),
        F.sum(F.coalesce("student_size", F.lit(0))).alias("total_enrollment"),
        steady_avg(F.col("student_size"), 6).alias("avg_enrollment"),
        as_percent(steady_avg(F.col("admission_rate"))).alias("avg_admission_rate_pct"),
        as_percent(steady_avg(F.col("completion_rate"))).alias("avg_completion_rate_pct"),
        whole_part(_money("tuition_in_state")).alias("avg_tuition_in_state"),
        whole_part(_money("tuition_out_of_state")).alias("avg_tuition_out_of_state"),
        whole_part(_money("median_debt")).alias("avg_median_debt"),
        whole_part(_money("earnings_10yr_median")).alias("avg_10yr_earnings"),
    )
    whole = F.sum("institution_count").over(_over_all())
    return grouped.withColumns(
        {
            "pct_of_total": share_of(F.col("institution_count"), whole),
            "display_order": K.size_position(F.col("size_category")),
            "size_category": _named_size(),
        }
    ).orderBy("display_order")


VIEWS = {
    "admissions_summary": admissions_summary,
    "state_performance": state_performance,
    "institution_detail": institution_detail,
    "size_category_analysis": size_category_analysis,
}


def register_views(df: DataFrame) -> None:
    """The four views as temporary views for `spark.sql`."""
    for name, view in VIEWS.items():
        view(df).createOrReplaceTempView(name)


# --- queries on the views --------------------------------------------------


def state_overview(df: DataFrame, min_schools: int = 50) -> DataFrame:
    """Performance of states with enough institutions, by value score."""
    return (
        state_performance(df)
        .filter(F.col("total_institutions") >= min_schools)
        .orderBy(F.desc("value_score"), "state_code")
        .select(
            "state_code",
            "avg_completion_rate_pct",
            "avg_10yr_earnings",
            "value_score",
            "state_performance_tier",
        )
    )


def institution_search(
    df: DataFrame, size: str = "large", low: float = 40, high: float = 70
) -> DataFrame:
    """Institutions of a size class within an admission range, by completion.

    An unknown admission rate counts as 0 percent here.
    """
    return (
        institution_detail(df)
        .filter((F.col("size_category") == size) & F.col("admission_rate_pct").between(low, high))
        .orderBy(F.desc("completion_rate_pct"), *TIES)
        .select(
            "school_name",
            "school_state",
            "selectivity_tier",
            "completion_tier",
            "tuition_in_state",
            "earnings_10yr_median",
        )
    )


# --- common filters --------------------------------------------------------


def in_state(df: DataFrame, state: str) -> DataFrame:
    return df.filter(F.col("school_state") == state)


def in_size_class(df: DataFrame, size: str) -> DataFrame:
    return df.filter(F.col("size_category") == size)


def highly_selective(df: DataFrame, below: float = 0.25) -> DataFrame:
    return df.filter(F.col("admission_rate") < below)


def top_performers(df: DataFrame, above: float = 0.80) -> DataFrame:
    return df.filter(F.col("completion_rate") > above).orderBy(F.desc("completion_rate"), *TIES)
