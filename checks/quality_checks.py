"""Quality checks on the raw records, and integrity checks on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from campusgrid.operators import clean as C
from campusgrid.operators import quality as Q
from campusgrid.operators import snapshots as S
from campusgrid.sources import records as R
from checks.registry import check
from checks.sql import inst
from checks.tables import RAW_SQL, institutions, raw_records, table


def raw(query: str) -> str:
    return f"WITH {RAW_SQL} {query}"


def _null_line(column: str, condition: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) AS rows,
      CAST(count(*) FILTER (WHERE {condition}) AS BIGINT) AS null_count,
      round(count(*) FILTER (WHERE {condition}) * 100.0 / count(*), 6)::DOUBLE AS null_percent
      FROM raw"""


@check(
    "v2_null_rates",
    raw(
        " UNION ALL ".join(
            [_null_line(c, f"{c} IS NULL") for c in ("school_name", "school_state")]
            + [
                _null_line(
                    "admission_rate_overall",
                    "admission_rate_overall IS NULL OR isnan(admission_rate_overall)",
                )
            ]
        )
    ),
)
def _(spark, sf_dir):
    return Q.null_counts(
        raw_records(spark, sf_dir), ("school_name", "school_state", "admission_rate_overall")
    )


@check(
    "v2_null_warnings",
    raw(f"""SELECT * FROM ({_null_line("school_name", "school_name IS NULL")}
      UNION ALL {_null_line("school_state", "school_state IS NULL")}) WHERE null_percent > 1.5"""),
)
def _(spark, sf_dir):
    return Q.null_warnings(raw_records(spark, sf_dir), threshold=1.5)



@check(
    "v3_coercion_losses",
    raw("""
      SELECT 'school_name' AS "column", 'string' AS expected, 0::BIGINT AS lost
      UNION ALL SELECT 'school_state', 'string', 0
      UNION ALL SELECT 'student_size', 'numeric',
        (SELECT count(student_size) FROM raw) - (SELECT count(student_size) FROM coerced)
      UNION ALL SELECT 'admission_rate_overall', 'float', 0
      UNION ALL SELECT 'completion_rate_overall', 'float', 0"""),
)
def _(spark, sf_dir):
    return Q.coercion_losses(raw_records(spark, sf_dir))


@check("v3_coerced_rows", raw("SELECT * FROM coerced"))
def _(spark, sf_dir):
    return Q.coerce_types(raw_records(spark, sf_dir))


def _range_line(column: str, low: str, high: str | None) -> str:
    above = f"count(*) FILTER (WHERE {column} > {high})" if high else "0"
    below = f"count(*) FILTER (WHERE {column} < {low})"
    return f"""SELECT '{column}' AS "column", CAST({below} AS BIGINT) AS below,
      CAST({above} AS BIGINT) AS above, CAST({below} + {above} AS BIGINT) AS violations,
      CAST(count(*) FILTER (WHERE out_of_range) AS BIGINT) AS rows_removed FROM flagged"""


@check(
    "v4_range_report",
    raw(
        " UNION ALL ".join(
            [
                _range_line("admission_rate_overall", "0", "1"),
                _range_line("completion_rate_overall", "0", "1"),
                _range_line("student_size", "0", None),
            ]
        )
    ),
)
def _(spark, sf_dir):
    return Q.range_report(Q.coerce_types(raw_records(spark, sf_dir)))


@check("v4_clean_rows", raw("SELECT * FROM ranged"))
def _(spark, sf_dir):
    return Q.keep_in_range(Q.coerce_types(raw_records(spark, sf_dir)))


@check("v4_flagged_rows", raw("SELECT * FROM flagged"))
def _(spark, sf_dir):
    return Q.flag_out_of_range(Q.coerce_types(raw_records(spark, sf_dir)))


COLUMNS = (
    "school_id",
    "school_name",
    "school_state",
    "student_size",
    "admission_rate_overall",
    "completion_rate_overall",
)


def _keep_sql(direction: str, nulls: str) -> str:
    order = ", ".join(f"{c} {direction} NULLS {nulls}" for c in COLUMNS)
    return raw(f"""SELECT * FROM coerced QUALIFY row_number() OVER (
      PARTITION BY school_name, school_state ORDER BY {order}) = 1""")


@check("v5_keep_first", _keep_sql("ASC", "FIRST"))
def _(spark, sf_dir):
    return Q.deduplicate(Q.coerce_types(raw_records(spark, sf_dir)), order_by=["school_id"])


@check("v5_keep_last", _keep_sql("DESC", "LAST"))
def _(spark, sf_dir):
    rows = Q.coerce_types(raw_records(spark, sf_dir))
    return Q.deduplicate(rows, keep="last", order_by=["school_id"])


@check(
    "v5_keep_none",
    raw("""SELECT * FROM coerced
      QUALIFY count(*) OVER (PARTITION BY school_name, school_state, student_size) = 1"""),
)
def _(spark, sf_dir):
    rows = Q.coerce_types(raw_records(spark, sf_dir))
    return Q.deduplicate(rows, ("school_name", "school_state", "student_size"), keep=False)


@check(
    "v5_duplicate_counts",
    raw("""SELECT CAST(sum(n) AS BIGINT) AS rows,
      CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS rows_involved,
      count(CASE WHEN n > 1 THEN 1 END) AS groups, CAST(sum(n - 1) AS BIGINT) AS rows_to_remove
      FROM (SELECT count(*) AS n FROM raw GROUP BY school_name, school_state)"""),
)
def _(spark, sf_dir):
    return Q.duplicate_counts(raw_records(spark, sf_dir))


REPORT = """
  SELECT 'CORRECTION' AS severity, 'types' AS "check", 'student_size' AS "column",
    (SELECT count(student_size) FROM raw) - (SELECT count(student_size) FROM coerced)
      AS affected_rows, 'values set to null' AS detail
  UNION ALL SELECT 'WARNING', 'ranges', 'admission_rate_overall', count(*), 'outside 0.0..1.0'
    FROM flagged WHERE admission_rate_overall < 0 OR admission_rate_overall > 1
  UNION ALL SELECT 'WARNING', 'ranges', 'completion_rate_overall', count(*), 'outside 0.0..1.0'
    FROM flagged WHERE completion_rate_overall < 0 OR completion_rate_overall > 1
  UNION ALL SELECT 'WARNING', 'ranges', 'student_size', count(*), 'outside 0..'
    FROM flagged WHERE student_size < 0
  UNION ALL SELECT 'CORRECTION', 'ranges', '', count(*), 'rows removed'
    FROM flagged WHERE out_of_range
  UNION ALL SELECT 'WARNING', 'duplicates', 'school_name,school_state',
    (SELECT count(*) FROM ranged) - (SELECT count(*) FROM unique_rows),
    (SELECT sum(n) FROM (SELECT count(*) AS n FROM ranged GROUP BY school_name, school_state)
      WHERE n > 1) || ' rows share a key'
  UNION ALL SELECT 'CORRECTION', 'duplicates', 'school_name,school_state',
    (SELECT count(*) FROM ranged) - (SELECT count(*) FROM unique_rows), 'rows removed'
  UNION ALL SELECT 'INFO', 'total_rows', '', count(*), '' FROM raw
  UNION ALL SELECT 'INFO', 'validated_rows', '', count(*), '' FROM unique_rows
  UNION ALL SELECT 'INFO', 'removed_rows', '',
    (SELECT count(*) FROM raw) - (SELECT count(*) FROM unique_rows), ''"""


@check("v6_validation_report", raw(REPORT))
def _(spark, sf_dir):
    return Q.validation_report(raw_records(spark, sf_dir))


@check("v6_validated_rows", raw("SELECT * FROM unique_rows"))
def _(spark, sf_dir):
    return Q.validate(raw_records(spark, sf_dir), order_by=["school_id"])


@check("v7_exact_duplicates", "SELECT DISTINCT text, lang, n_chars FROM documents")
def _(spark, sf_dir):
    return C.drop_exact_duplicates(
        table(spark, sf_dir, "documents").select("text", "lang", "n_chars")
    )


@check(
    "v7_integrity_counts",
    raw("""
      SELECT CAST(sum(n) AS BIGINT) AS rows_before,
        CAST(sum(n - 1) AS BIGINT) AS duplicates_removed,
        count(CASE WHEN negative THEN 1 END) AS negative_rows_removed,
        count(CASE WHEN NOT negative THEN 1 END) AS rows_after
      FROM (SELECT count(*) AS n, coalesce(student_size < 0, FALSE)
          OR coalesce(admission_rate < 0, FALSE) OR coalesce(completion_rate < 0, FALSE)
          AS negative
        FROM (SELECT school_name, school_state, student_size,
          admission_rate_overall AS admission_rate, completion_rate_overall AS completion_rate
          FROM coerced)
        GROUP BY school_name, school_state, student_size, admission_rate, completion_rate)"""),
)
def _(spark, sf_dir):
    rows = Q.coerce_types(raw_records(spark, sf_dir)).drop("school_id")
    return C.integrity_counts(C.standardize_columns(rows))


@check("v8_negative_rows", "SELECT * FROM customer WHERE c_acctbal >= 0 OR c_acctbal IS NULL")
def _(spark, sf_dir):
    return C.drop_negatives(table(spark, sf_dir, "customer"), ("c_acctbal", "c_custkey"))


@check(
    "v9_report_summary",
    raw(f"""SELECT count(CASE WHEN severity = 'ERROR' THEN 1 END) AS errors,
      count(CASE WHEN severity = 'WARNING' THEN 1 END) AS warnings,
      count(CASE WHEN severity = 'CORRECTION' THEN 1 END) AS corrections,
      count(CASE WHEN severity = 'ERROR' THEN 1 END) = 0 AS is_valid
      FROM ({REPORT}) WHERE severity = 'INFO' OR affected_rows > 0"""),
)
def _(spark, sf_dir):
    return Q.report_summary(Q.validation_report(raw_records(spark, sf_dir)))


def _filled_line(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS filled,
      round(count({column}) * 100.0 / count(*), 6)::DOUBLE AS filled_percent,
      count(*) AS rows, count(DISTINCT school_state) AS states FROM inst"""


FILLED = ("school_name", "school_state", "student_size", "admission_rate", "completion_rate")


@check("v10_completeness", inst(" UNION ALL ".join(_filled_line(c) for c in FILLED)))
def _(spark, sf_dir):
    return Q.completeness(institutions(spark, sf_dir, *FILLED), FILLED)


STATS = ("school_state", "student_size", "admission_rate", "completion_rate")


@check(
    "v11_extraction_stats",
    inst(
        """SELECT 'total_records' AS metric, '' AS "column", count(*)::DOUBLE AS value FROM inst
        UNION ALL SELECT 'columns', '', 4
        UNION ALL SELECT 'states_covered', 'school_state', count(DISTINCT school_state) FROM inst
        UNION ALL SELECT 'total_students', 'student_size', sum(student_size) FROM inst
        UNION ALL SELECT 'avg_student_size', 'student_size', round(avg(student_size), 6) FROM inst
        UNION ALL SELECT 'avg_admission_rate', 'admission_rate_overall',
          round(avg(admission_rate), 6) FROM inst
        UNION ALL SELECT 'avg_completion_rate', 'completion_rate_overall',
          round(avg(completion_rate), 6) FROM inst """
        + " ".join(
            f"""UNION ALL SELECT 'missing_values', '{name}', count(*) - count({c}) FROM inst
            UNION ALL SELECT 'completeness', '{name}',
              round(count({c}) * 100.0 / count(*), 6) FROM inst"""
            for c, name in zip(
                STATS,
                (
                    "school_state",
                    "student_size",
                    "admission_rate_overall",
                    "completion_rate_overall",
                ),
            )
        )
    ),
)
def _(spark, sf_dir):
    df = institutions(spark, sf_dir, *STATS).withColumnsRenamed(
        {
            "admission_rate": "admission_rate_overall",
            "completion_rate": "completion_rate_overall",
        }
    )
    return Q.extraction_stats(df).withColumn("value", F.round("value", 6))


@check(
    "v12_repeated_keys",
    inst("SELECT school_id, count(*) AS rows FROM inst GROUP BY school_id HAVING count(*) > 1"),
)
def _(spark, sf_dir):
    return Q.repeated_keys(institutions(spark, sf_dir, "school_id"))


@check(
    "v14_field_presence",
    """SELECT * FROM (
      SELECT 'school.name' AS field, TRUE AS "exists", 'latest.school.name' AS found_path,
        '' AS available, count(c_name) AS present_rows, count(*) AS rows FROM customer
      UNION ALL SELECT 'school.state', FALSE, 'latest.school', 'name,segment', 0, count(*)
        FROM customer
      UNION ALL SELECT 'latest.student.size', TRUE, 'latest.student.size', '',
        count(CASE WHEN c_acctbal >= 0 THEN 1 END), count(*) FROM customer
      UNION ALL SELECT 'latest.admissions.admission_rate.overall', FALSE, 'latest',
        'school,student', 0, count(*) FROM customer
      UNION ALL SELECT 'latest.completion.rate_suppressed.overall', FALSE, 'latest',
        'school,student', 0, count(*) FROM customer)""",
)
def _(spark, sf_dir):
    from campusgrid.schema import NESTED_PATHS

    nested = table(spark, sf_dir, "customer").select(
        F.struct(
            F.struct(
                F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
            ).alias("school"),
            F.struct(F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("size")).alias(
                "student"
            ),
        ).alias("latest")
    )
    return R.field_presence(nested, NESTED_PATHS)


@check(
    "v15_layer_report",
    """SELECT 'raw' AS layer, count(*) AS rows, 11 AS columns FROM lineitem
      UNION ALL SELECT 'staging', count(*), 6 FROM orders
      UNION ALL SELECT 'processed', count(*), 5 FROM customer""",
)
def _(spark, sf_dir):
    return S.layer_report(
        spark,
        {
            "raw": table(spark, sf_dir, "lineitem"),
            "staging": table(spark, sf_dir, "orders"),
            "processed": table(spark, sf_dir, "customer"),
        },
    )


@check(
    "v16_class_shares",
    inst("""SELECT size_category, count(*) AS rows,
      round(count(*) * 100.0 / sum(count(*)) OVER (), 6)::DOUBLE AS percent
      FROM inst GROUP BY size_category"""),
)
def _(spark, sf_dir):
    return Q.class_shares(institutions(spark, sf_dir, "size_category"))


def _measure_line(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS "values", min({column}) AS min,
      max({column}) AS max, round(avg({column}), 6) AS mean FROM inst"""


MEASURED = ("admission_rate_percentage", "completion_rate_percentage")


@check("v17_value_range", inst(" UNION ALL ".join(_measure_line(c) for c in MEASURED)))
def _(spark, sf_dir):
    df = Q.value_range(institutions(spark, sf_dir, *MEASURED), MEASURED)
    return df.withColumn("mean", F.round("mean", 6))


@check(
    "v1_required_columns",
    raw("""SELECT school_id, school_state FROM raw UNION ALL
      SELECT NULL, 'missing: school_nation, school_planet'"""),
)
def _(spark, sf_dir):
    """A table that has the required columns passes as it is; the error names those one lacks."""
    rows = raw_records(spark, sf_dir)
    passed = Q.require_columns(rows).select("school_id", "school_state")
    lacking = Q.missing_columns(rows, [*Q.REQUIRED_COLUMNS, "school_nation", "school_planet"])
    note = F.lit(f"missing: {', '.join(lacking)}").alias("school_state")
    return passed.unionByName(rows.agg(F.min("school_id")).select(F.lit(None).cast("bigint").alias("school_id"), note))
