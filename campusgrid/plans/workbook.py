"""Queries of the dashboard sheets.

They apply row filters first, then the top n, then filters on aggregates, then
reference lines and shares over the rows that are left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campusgrid.functions.numbers import attribute, linear_fit, steady_avg
from campusgrid.operators.joins import count_related
from campusgrid.schema import GROUP_MEMBERS, SHEET_STATES, SIZE_ORDER

def _reference_line(df: DataFrame, column: str, places: int = 10) -> DataFrame:
    """Add the mean of the shown values."""
    mean = F.round(F.avg(column).over(Window.partitionBy()), places)
    return df.withColumn("reference_line", mean)


# --- institutions ----------------------------------------------------------


def least_selective_states(
    df: DataFrame,
    n: int = 10,
    min_schools: int = 20,
    low: float = 0.62108889,
    high: float = 1.0,
) -> DataFrame:
    """Top n states by average admission rate among those with enough schools."""
    top = (
        df.groupBy("school_state")
        .agg(
            F.count("school_name").alias("schools"),
            steady_avg(F.col("admission_rate")).alias("avg_admission_rate"),
        )
        .filter(F.col("schools") >= min_schools)
        .orderBy(F.desc("avg_admission_rate"), "school_state")
        .limit(n)
    )
    shown = top.filter(F.col("avg_admission_rate").between(low, high))
    return _reference_line(shown, "avg_admission_rate").orderBy(
        F.desc("avg_admission_rate"), "school_state"
    )


def rate_points(df: DataFrame) -> DataFrame:
    """Average admission and completion rate of each school name."""
    return (
        df.filter(F.col("admission_rate").isNotNull() & F.col("completion_rate").isNotNull())
        .groupBy("school_name")
        .agg(
            steady_avg(F.col("admission_rate")).alias("avg_admission_rate"),
            steady_avg(F.col("completion_rate")).alias("avg_completion_rate"),
        )
    )


def rate_trend(df: DataFrame) -> DataFrame:
    """The straight line through the points: completion on admission."""
    x, y = F.col("avg_admission_rate"), F.col("avg_completion_rate")
    return rate_points(df).agg(*linear_fit(y, x))


def state_completion(df: DataFrame, n: int = 10) -> DataFrame:
    """Average completion of the n states with the most schools."""
    top = (
        df.groupBy("school_state")
        .agg(
            F.count("school_name").alias("schools"),
            steady_avg(F.col("completion_rate")).alias("avg_completion_rate"),
        )
        .orderBy(F.desc("schools"), "school_state")
        .limit(n)
    )
    return _reference_line(top, "avg_completion_rate").orderBy(
        F.desc("avg_completion_rate"), "school_state"
    )


def size_shares(df: DataFrame, members: Sequence[str] = SIZE_ORDER) -> DataFrame:
    """Share of each known size class."""
    counts = (
        df.filter(F.col("size_category").isin(*members))
        .groupBy("size_category")
        .agg(F.count("size_category").alias("schools"))
    )
    whole = F.sum("schools").over(Window.partitionBy())
    return counts.withColumn("share", F.round(F.col("schools") / whole, 10))


def largest_names(df: DataFrame, n: int = 10) -> DataFrame:
    """The n school names with the most students, split by size class.

    Schools of one name in several states count together. The second step works
    on the sums per name and class, and the top-n list it joins has n rows.
    """
    sums = df.groupBy("school_name", "size_category").agg(
        F.sum("student_size").alias("students")
    )
    top = (
        sums.groupBy("school_name")
        .agg(F.sum("students").alias("name_total"))
        .orderBy(F.desc("name_total"), "school_name")
        .limit(n)
    )
    named = F.broadcast(top.withColumnRenamed("school_name", "_name"))
    return (
        sums.join(named, F.col("school_name").eqNullSafe(F.col("_name")))
        .drop("_name")
        .orderBy(F.desc("name_total"), "school_name", "size_category")
    )


# --- sales -----------------------------------------------------------------


def product_places(
    instructions: DataFrame,
    low: int = 6,
    high: int = 19,
    groups: Sequence[str] = GROUP_MEMBERS,
    states: Sequence[str] = SHEET_STATES,
) -> DataFrame:
    """Places where the groups were sold in the given quantities."""
    return (
        instructions.filter(
            F.col("Group").isin(*groups) & F.col("Qty").between(low, high) & F.col("State or Province").isin(*states)
        )
        .select(F.col("State or Province"), F.col("Postal Code"), F.col("Group"))
        .distinct()
    )


def technology_places(
    instructions: DataFrame, quantity: int = 19, states: Sequence[str] = SHEET_STATES
) -> DataFrame:
    return product_places(instructions, quantity, quantity, ("Technology",), states)


def reductions(instructions: DataFrame) -> DataFrame:
    """Average reduction and revenue by state and sub-group."""
    return instructions.groupBy(F.col("State or Province"), F.col("Sub-Group")).agg(
        F.avg("Reduction").alias("avg_reduction"),
        F.sum("Revenue").alias("revenue"),
        attribute(F.col("Group")).alias("group"),
    )


def reimbursement_places(
    instructions: DataFrame, reimbursements: DataFrame, low: int = 1, high: int = 12
) -> DataFrame:
    """Places by number of reimbursements, within limits."""
    counts = count_related(
        instructions,
        reimbursements,
        "Instruction ID",
        ["State or Province", "Postal Code"],
        "reimbursements",
    )
    return counts.filter(F.col("reimbursements").between(low, high))


def revenue_by_group(
    instructions: DataFrame, states: Sequence[str] = SHEET_STATES
) -> DataFrame:
    return (
        instructions.filter(F.col("State or Province").isin(*states))
        .groupBy(F.col("Group"), F.col("State or Province"), F.col("Sub-Group"))
        .agg(F.sum("Revenue").alias("revenue"))
    )


def state_revenue(
    instructions: DataFrame,
    low: float = 29960.0,
    high: float = 741351.948,
    groups: Sequence[str] = GROUP_MEMBERS,
    without: Sequence[str] = ("Furniture",),
    not_containing: str = "New",
    sort_group: str = "Technology",
) -> DataFrame:
    """Revenue by state and group within limits, states by their revenue in one group.

    The sort value comes from the grouped rows, a few per state.
    """
    named = F.coalesce(~F.col("State or Province").contains(not_containing), F.lit(True))
    grouped = (
        instructions.filter(F.col("Group").isin(*groups) & ~F.col("Group").isin(*without) & named)
        .groupBy(F.col("State or Province"), F.col("Group"))
        .agg(F.sum("Revenue").alias("revenue"))
        .filter(F.round(F.col("revenue"), 6).between(low, high))
    )
    per_state = Window.partitionBy(F.col("State or Province"))
    sort_value = F.max(F.when(F.col("Group") == sort_group, F.col("revenue"))).over(per_state)
    return grouped.withColumn("sort_revenue", sort_value).orderBy(
        F.desc("sort_revenue"), F.col("State or Province"), F.col("Group")
    )
