"""Queries of the dashboard sheets."""

from __future__ import annotations

from pyspark.sql import functions as F

from campusgrid.plans import workbook as W
from checks.registry import check
from checks.sql import avg, inst
from checks.tables import INSTRUCTIONS_SQL, institutions, instructions, reimbursements

STATES = tuple(f"NATION_{i}" for i in range(12)) + ("New NATION_5", "New NATION_10")
STATES_SQL = ", ".join(f"'{s}'" for s in STATES)
PLACE = '"State or Province"'


def sales(query: str) -> str:
    return f"WITH {INSTRUCTIONS_SQL} {query}"


def money(column: str) -> str:
    """A sum of cents, exact."""
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


@check(
    "b1_least_selective_states",
    inst(f"""
      SELECT *, round(avg(avg_admission_rate) OVER (), 10) AS reference_line
      FROM (SELECT * FROM (
          SELECT school_state, count(school_name) AS schools,
            {avg("admission_rate")} AS avg_admission_rate
          FROM inst GROUP BY school_state HAVING count(school_name) >= 700)
        ORDER BY avg_admission_rate DESC, school_state LIMIT 10)
      WHERE avg_admission_rate BETWEEN 0.5 AND 1.0"""),
)
def _(spark, sf_dir):
    df = institutions(spark, sf_dir, "school_name", "school_state", "admission_rate")
    return W.least_selective_states(df, min_schools=700, low=0.5)


@check(
    "b2_rate_points",
    inst(f"""
      SELECT school_name, {avg("admission_rate")} AS avg_admission_rate,
        {avg("completion_rate")} AS avg_completion_rate
      FROM inst WHERE admission_rate IS NOT NULL AND completion_rate IS NOT NULL
      GROUP BY school_name"""),
)
def _(spark, sf_dir):
    df = institutions(spark, sf_dir, "school_name", "admission_rate", "completion_rate")
    return W.rate_points(df)


@check(
    "b2_rate_trend",
    inst(f"""
      SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept,
        round(regr_r2(y, x), 6) AS r2, round(corr(y, x), 6) AS correlation,
        CAST(regr_count(y, x) AS BIGINT) AS points
      FROM (SELECT {avg("admission_rate")} AS x, {avg("completion_rate")} AS y
        FROM inst WHERE admission_rate IS NOT NULL AND completion_rate IS NOT NULL
        GROUP BY school_name)"""),
)
def _(spark, sf_dir):
    df = institutions(spark, sf_dir, "school_name", "admission_rate", "completion_rate")
    trend = W.rate_trend(df)
    return trend.select(*[F.round(c, 6).alias(c) for c in trend.columns[:4]], "points")


@check(
    "b3_state_completion",
    inst(f"""
      SELECT *, round(avg(avg_completion_rate) OVER (), 10) AS reference_line
      FROM (SELECT school_state, count(school_name) AS schools,
          {avg("completion_rate")} AS avg_completion_rate
        FROM inst GROUP BY school_state ORDER BY schools DESC, school_state LIMIT 10)"""),
)
def _(spark, sf_dir):
    df = institutions(spark, sf_dir, "school_name", "school_state", "completion_rate")
    return W.state_completion(df)


@check(
    "b4_size_shares",
    inst("""
      SELECT size_category, count(*) AS schools,
        round(count(*) / sum(count(*)) OVER (), 10)::DOUBLE AS share
      FROM inst WHERE size_category IN ('large', 'medium', 'small') GROUP BY size_category"""),
)
def _(spark, sf_dir):
    return W.size_shares(institutions(spark, sf_dir, "size_category"))


@check(
    "b5_largest_names",
    inst("""
      SELECT i.school_name, i.size_category, sum(i.student_size) AS students, t.name_total
      FROM inst i JOIN (SELECT school_name, sum(student_size) AS name_total FROM inst
          GROUP BY school_name ORDER BY name_total DESC, school_name LIMIT 10) t
        ON i.school_name IS NOT DISTINCT FROM t.school_name
      GROUP BY i.school_name, i.size_category, t.name_total"""),
)
def _(spark, sf_dir):
    return W.largest_names(
        institutions(spark, sf_dir, "school_name", "student_size", "size_category")
    )


@check(
    "b12_names_by_argument",
    inst("""
      SELECT i.school_name, i.size_category, sum(i.student_size) AS students, t.name_total
      FROM inst i JOIN (SELECT school_name, sum(student_size) AS name_total FROM inst
          GROUP BY school_name ORDER BY name_total DESC, school_name LIMIT 20) t
        ON i.school_name IS NOT DISTINCT FROM t.school_name
      GROUP BY i.school_name, i.size_category, t.name_total"""),
)
def _(spark, sf_dir):
    return W.largest_names(
        institutions(spark, sf_dir, "school_name", "student_size", "size_category"), n=20
    )


SOLD = ("Group", "Qty", "State or Province", "Postal Code")


@check(
    "b6_product_places",
    sales(f"""
      SELECT DISTINCT {PLACE}, "Postal Code", "Group" FROM instructions
      WHERE "Group" IN ('Furniture', 'Office Supplies', 'Technology')
        AND "Qty" BETWEEN 6 AND 19 AND {PLACE} IN ({STATES_SQL})"""),
)
def _(spark, sf_dir):
    return W.product_places(instructions(spark, sf_dir, *SOLD), states=STATES)


@check(
    "b7_reductions",
    sales(f"""
      SELECT {PLACE}, "Sub-Group", round(avg("Reduction"), 6) AS avg_reduction,
        {money('"Revenue"')} AS revenue,
        CASE WHEN min("Group") = max("Group") THEN min("Group") ELSE '*' END AS "group"
      FROM instructions GROUP BY ALL"""),
)
def _(spark, sf_dir):
    df = instructions(
        spark, sf_dir, "State or Province", "Sub-Group", "Reduction", "Revenue", "Group"
    )
    return W.reductions(df).withColumns(
        {"avg_reduction": F.round("avg_reduction", 6), "revenue": F.round("revenue", 2)}
    )


def _reimbursed(low: int, high: int) -> str:
    return sales(f"""
      SELECT {PLACE}, "Postal Code", CAST(coalesce(sum(n), 0) AS BIGINT) AS reimbursements
      FROM (SELECT DISTINCT "Instruction ID", {PLACE}, "Postal Code" FROM instructions)
      LEFT JOIN (SELECT "Instruction ID", count(*) AS n FROM reimbursements GROUP BY ALL)
        USING ("Instruction ID")
      GROUP BY {PLACE}, "Postal Code" HAVING coalesce(sum(n), 0) BETWEEN {low} AND {high}""")


RELATED = ("Instruction ID", "State or Province", "Postal Code")


@check("b8_reimbursement_places", _reimbursed(1, 12))
def _(spark, sf_dir):
    return W.reimbursement_places(
        instructions(spark, sf_dir, *RELATED), reimbursements(spark, sf_dir)
    )


@check(
    "b9_revenue_by_group",
    sales(f"""
      SELECT "Group", {PLACE}, "Sub-Group", {money('"Revenue"')} AS revenue
      FROM instructions WHERE {PLACE} IN ({STATES_SQL}) GROUP BY ALL"""),
)
def _(spark, sf_dir):
    df = instructions(spark, sf_dir, "Group", "State or Province", "Sub-Group", "Revenue")
    return W.revenue_by_group(df, STATES).withColumn("revenue", F.round("revenue", 2))


@check(
    "b10_technology_places",
    sales(f"""
      SELECT DISTINCT {PLACE}, "Postal Code", "Group" FROM instructions
      WHERE "Group" = 'Technology' AND "Qty" = 19 AND {PLACE} IN ({STATES_SQL})"""),
)
def _(spark, sf_dir):
    return W.technology_places(instructions(spark, sf_dir, *SOLD), states=STATES)


@check("b10_many_reimbursements", _reimbursed(5, 12))
def _(spark, sf_dir):
    return W.reimbursement_places(
        instructions(spark, sf_dir, *RELATED), reimbursements(spark, sf_dir), 5, 12
    )


@check(
    "b11_state_revenue",
    sales(f"""
      SELECT *, max(CASE WHEN "Group" = 'Technology' THEN revenue END)
        OVER (PARTITION BY {PLACE}) AS sort_revenue
      FROM (SELECT {PLACE}, "Group", {money('"Revenue"')} AS revenue FROM instructions
        WHERE "Group" IN ('Furniture', 'Office Supplies', 'Technology')
          AND "Group" <> 'Furniture' AND ({PLACE} IS NULL OR NOT contains({PLACE}, 'New'))
        GROUP BY ALL)
      WHERE revenue BETWEEN 20000000 AND 45000000"""),
)
def _(spark, sf_dir):
    df = instructions(spark, sf_dir, "State or Province", "Group", "Revenue")
    rows = W.state_revenue(df, low=20_000_000, high=45_000_000)
    return rows.withColumns(
        {"revenue": F.round("revenue", 2), "sort_revenue": F.round("sort_revenue", 2)}
    )
