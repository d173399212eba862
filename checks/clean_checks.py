"""Cleaning of names, values and derived columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from campusgrid.functions.classes import code_label, size_category
from campusgrid.functions.numbers import to_double, to_long
from campusgrid.operators import clean as C
from campusgrid.operators import quality as Q
from campusgrid.schema import OWNERSHIP_LABELS, REGION_LABELS
from campusgrid.sources import records as R
from checks.quality_checks import raw
from checks.registry import check
from checks.sql import inst
from checks.tables import SQL_BLANKS, SQL_NUMBER, institutions, raw_records, table

TOKENS = "('nan', 'None', 'NaN', '', 'null', 'NULL')"


def stripped(column: str) -> str:
    return f"trim({column}, {SQL_BLANKS})"


def cleaned(column: str) -> str:
    return f"CASE WHEN {stripped(column)} NOT IN {TOKENS} THEN {stripped(column)} END"


def state(column: str) -> str:
    return f"""CASE WHEN upper({cleaned(column)}) NOT IN ('NAN', 'NONE', '')
      THEN upper({cleaned(column)}) END"""


@check(
    "p1_snake_case_columns",
    """SELECT c_custkey AS customer_key, c_name AS customer_name, c_acctbal AS account_balance
      FROM customer""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customerKey"),
        F.col("c_name").alias("Customer Name"),
        F.col("c_acctbal").alias("ACCOUNT-BALANCE"),
    )
    return C.standardize_columns(df)


@check(
    "p2_standardize_columns",
    raw("""SELECT school_id, school_name, school_state, student_size,
      admission_rate_overall AS admission_rate, completion_rate_overall AS completion_rate
      FROM raw"""),
)
def _(spark, sf_dir):
    return C.standardize_columns(raw_records(spark, sf_dir))


@check(
    "p3_field_column_names",
    """SELECT c_custkey AS school_id, c_name AS school_name, c_acctbal AS latest_other_rate_total
      FROM customer""",
)
def _(spark, sf_dir):
    from campusgrid.functions.text import field_column_name
    from campusgrid.schema import FIELD_TO_COLUMN

    names = {"c_custkey": "id", "c_name": "school.name", "c_acctbal": "latest.other-rate.Total"}
    return table(spark, sf_dir, "customer").select(
        *[F.col(c).alias(field_column_name(f, FIELD_TO_COLUMN)) for c, f in names.items()]
    )


@check(
    "p4_short_names",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS student_size FROM customer""",
)
def _(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("school.name"),
        F.col("c_acctbal").alias("latest.student.size"),
    )
    return R.short_names(df)


@check("p5_prefix_columns", 'SELECT s_suppkey, s_name AS "HD_s_name" FROM supplier')
def _(spark, sf_dir):
    df = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return C.prefix_columns(df, "HD", ["s_suppkey"])


@check(
    "p6_cleaning_counts",
    raw(f"""SELECT count(*) AS rows,
      CAST(count(CASE WHEN school_name <> {stripped("school_name")} THEN 1 END)
        + count(CASE WHEN school_state <> {stripped("school_state")} THEN 1 END)
        + count(CASE WHEN student_size <> {stripped("student_size")} THEN 1 END) AS BIGINT)
        AS cells_trimmed,
      count(CASE WHEN {cleaned("school_state")} <> {state("school_state")} THEN 1 END)
        AS states_changed,
      count(CASE WHEN length({state("school_state")}) <> 2 THEN 1 END) AS odd_states
      FROM raw"""),
)
def _(spark, sf_dir):
    return C.cleaning_counts(raw_records(spark, sf_dir))


@check(
    "p7_clean_strings",
    raw(f"""SELECT school_id, {cleaned("school_name")} AS school_name,
      {cleaned("school_state")} AS school_state FROM raw"""),
)
def _(spark, sf_dir):
    return C.clean_strings(
        raw_records(spark, sf_dir).select("school_id", "school_name", "school_state")
    )


@check(
    "p8_clean_states",
    raw(f"SELECT school_id, {state('school_state')} AS school_state FROM raw"),
)
def _(spark, sf_dir):
    rows = raw_records(spark, sf_dir).select("school_id", "school_state")
    return C.clean_states(C.clean_strings(rows))


@check(
    "p9_numeric_coercion",
    raw(f"""SELECT school_id,
      CASE WHEN regexp_matches({stripped("student_size")}, {SQL_NUMBER})
        THEN TRY_CAST({stripped("student_size")} AS DOUBLE) END AS as_double,
      CAST(CASE WHEN regexp_matches({stripped("student_size")}, {SQL_NUMBER})
        AND TRY_CAST({stripped("student_size")} AS DOUBLE)
          = floor(TRY_CAST({stripped("student_size")} AS DOUBLE))
        THEN TRY_CAST({stripped("student_size")} AS DOUBLE) END AS BIGINT) AS as_long
      FROM raw"""),
)
def _(spark, sf_dir):
    df = raw_records(spark, sf_dir)
    size, kind = F.col("student_size"), df.schema["student_size"].dataType
    return df.select(
        "school_id", to_double(size, kind).alias("as_double"), to_long(size, kind).alias("as_long")
    )


@check(
    "p10_null_profile",
    inst(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS null_count,
            round((count(*) - count({c})) * 100.0 / count(*), 6)::DOUBLE AS null_percent FROM inst"""
            for c in (
                "student_size",
                "grad_students",
                "admission_rate",
                "completion_rate",
                "completion_rate_4yr",
                "tuition_in_state",
            )
        )
    ),
)
def _(spark, sf_dir):
    return Q.null_counts(
        institutions(
            spark,
            sf_dir,
            "student_size",
            "grad_students",
            "admission_rate",
            "completion_rate",
            "completion_rate_4yr",
            "tuition_in_state",
        )
    )


@check(
    "p11_percentages",
    inst("""SELECT school_id, admission_rate, completion_rate, admission_rate_percentage,
      completion_rate_percentage FROM inst"""),
)
def _(spark, sf_dir):
    return C.add_percentages(
        institutions(spark, sf_dir, "school_id", "admission_rate", "completion_rate")
    )


@check("p12_size_category", inst("SELECT school_id, student_size, size_category FROM inst"))
def _(spark, sf_dir):
    return institutions(spark, sf_dir, "school_id", "student_size").withColumn(
        "size_category", size_category(F.col("student_size"))
    )


def labels(column: str, names: dict[int, str]) -> str:
    whens = " ".join(f"WHEN {code} THEN '{label}'" for code, label in names.items())
    return f"CASE {column} {whens} END"


@check(
    "p13_code_labels",
    inst(f"""SELECT school_id, {labels("ownership", OWNERSHIP_LABELS)} AS ownership_label,
      {labels("region_id", REGION_LABELS)} AS region_label FROM inst"""),
)
def _(spark, sf_dir):
    return institutions(spark, sf_dir, "school_id", "ownership", "region_id").select(
        "school_id",
        code_label(F.col("ownership"), OWNERSHIP_LABELS).alias("ownership_label"),
        code_label(F.col("region_id"), REGION_LABELS).alias("region_label"),
    )


@check(
    "p14_undergrad_and_tuition",
    inst("""SELECT school_id, student_size - coalesce(grad_students, 0) AS undergrad_size,
      coalesce(tuition_out_of_state, 0) - coalesce(tuition_in_state, 0) AS tuition_difference
      FROM inst"""),
)
def _(spark, sf_dir):
    df = institutions(
        spark,
        sf_dir,
        "school_id",
        "student_size",
        "grad_students",
        "tuition_in_state",
        "tuition_out_of_state",
    )
    return R.with_labels_and_sizes(df).select("school_id", "undergrad_size", "tuition_difference")


@check(
    "p16_first_columns",
    raw("""SELECT school_id, school_name, school_state, student_size, admission_rate_overall,
      completion_rate_overall FROM raw"""),
)
def _(spark, sf_dir):
    rows = raw_records(spark, sf_dir)
    mixed = rows.select(*sorted(rows.columns))
    return R.first_columns(mixed, ("school_id", "school_name"))


@check(
    "p17_origin",
    "SELECT c_custkey, TIMESTAMP '2024-01-02 03:04:05' AS _extracted_at, 'api' AS _source "
    "FROM customer",
)
def _(spark, sf_dir):
    stamp = F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")
    return R.with_origin(table(spark, sf_dir, "customer").select("c_custkey"), "api", stamp)


@check(
    "p18_transform",
    raw(f"""SELECT * FROM (
      SELECT DISTINCT school_name, school_state, student_size, admission_rate, completion_rate,
        admission_rate * 100 AS admission_rate_percentage,
        completion_rate * 100 AS completion_rate_percentage,
        CASE WHEN student_size < 5000 THEN 'small' WHEN student_size <= 15000 THEN 'medium'
          WHEN student_size > 15000 THEN 'large' END AS size_category
      FROM (SELECT {cleaned("school_name")} AS school_name, {state("school_state")} AS school_state,
        student_size, admission_rate_overall AS admission_rate,
        completion_rate_overall AS completion_rate FROM coerced))
      WHERE NOT (coalesce(student_size < 0, FALSE) OR coalesce(admission_rate < 0, FALSE)
        OR coalesce(completion_rate < 0, FALSE))"""),
)
def _(spark, sf_dir):
    return C.transform(raw_records(spark, sf_dir).drop("school_id"))
