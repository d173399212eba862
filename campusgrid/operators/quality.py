"""Quality checks. Each report is a DataFrame, all its counters from one aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.functions.numbers import nan_to_null, to_double
from campusgrid.functions.text import quoted
from campusgrid.schema import (
    COMPLETENESS_FIELDS,
    CRITICAL_COLUMNS,
    DUPLICATE_KEY,
    EXPECTED_TYPES,
    NULL_THRESHOLD_PERCENT,
    RANGES,
    REQUIRED_COLUMNS,
)

Ranges = Mapping[str, tuple[float | None, float | None]]

REPORT = "severity string, check string, column string, affected_rows bigint, detail string"
ERROR, WARNING, CORRECTION, INFO = "ERROR", "WARNING", "CORRECTION", "INFO"


class SchemaError(Exception):
    """Required columns are missing."""


def _total(col: Column | str) -> Column:
    return F.coalesce(F.sum(col), F.lit(0)).cast("bigint")


def _missing(col: Column, dtype: T.DataType) -> Column:
    """Null, or NaN in a column of doubles."""
    return nan_to_null(col, dtype).isNull()


def _percent(part: Column, whole: Column) -> Column:
    """part / whole in percent as double, null for an empty table."""
    return F.try_divide(part * F.lit(100.0), whole)


# --- columns ---------------------------------------------------------------


def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """The table itself, or an error that names what is missing. Runs no job."""
    if missing := missing_columns(df, required):
        raise SchemaError(f"missing columns: {', '.join(missing)}")
    return df


# --- nulls -----------------------------------------------------------------


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, nulls and null percentage of each column (all columns by default)."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count_if(_missing(quoted(f.name), f.dataType)).alias(f"_{i}")
            for i, f in enumerate(fields)
        ],
    )
    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.col("rows"),
            F.col(f"_{i}").alias("null_count"),
            F.round(_percent(F.col(f"_{i}"), F.col("rows")), 6).alias("null_percent"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def null_warnings(
    df: DataFrame,
    columns: Sequence[str] = CRITICAL_COLUMNS,
    threshold: float = NULL_THRESHOLD_PERCENT,
) -> DataFrame:
    """The columns whose null percentage is above the threshold. No row is removed."""
    return null_counts(df, columns).filter(F.col("null_percent") > threshold)


def completeness(
    df: DataFrame,
    columns: Sequence[str] = COMPLETENESS_FIELDS,
    distinct: str = "school_state",
) -> DataFrame:
    """Filled cells and percentage of the key fields, with the number of distinct states."""
    names = [c for c in columns if c in df.columns]
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(F.col(distinct)).alias("states"),
        *[F.count_if(~_missing(F.col(c), df.schema[c].dataType)).alias(f"_{i}") for i, c in enumerate(names)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"_{i}").alias("filled"),
            F.round(_percent(F.col(f"_{i}"), F.col("rows")), 6).alias("filled_percent"),
            F.col("rows"),
            F.col("states"),
        )
        for i, c in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*rows)))


def extraction_stats(df: DataFrame) -> DataFrame:
    """Statistics of an extract as (metric, column, value) rows, from one aggregate."""
    has = set(df.columns)

    def value(column: str) -> Column:
        return F.when(~_missing(F.col(column), df.schema[column].dataType), F.col(column))

    measures: list[tuple[str, str, Column]] = [
        ("total_records", "", F.count(F.lit(1))),
        ("columns", "", F.lit(len(df.columns))),
    ]
    if "school_state" in has:
        measures.append(("states_covered", "school_state", F.countDistinct("school_state")))
    if "student_size" in has:
        measures.append(("total_students", "student_size", F.sum(value("student_size"))))
        measures.append(("avg_student_size", "student_size", F.avg(value("student_size"))))
    for metric, column in (
        ("avg_admission_rate", "admission_rate_overall"),
        ("avg_completion_rate", "completion_rate_overall"),
    ):
        if column in has:
            measures.append((metric, column, F.avg(value(column))))
    for field in df.schema.fields:
        missing = F.count_if(_missing(quoted(field.name), field.dataType))
        filled = _percent(F.count(F.lit(1)) - missing, F.count(F.lit(1)))
        measures.append(("missing_values", field.name, missing))
        measures.append(("completeness", field.name, filled))
    wide = df.agg(*[m.cast("double").alias(f"_{i}") for i, (_, _, m) in enumerate(measures)])
    rows = [
        F.struct(
            F.lit(metric).alias("metric"), F.lit(column).alias("column"), F.col(f"_{i}").alias("value")
        )
        for i, (metric, column, _) in enumerate(measures)
    ]
    return wide.select(F.inline(F.array(*rows)))


# --- types -----------------------------------------------------------------


def _coerced(field: T.StructField, expected: str) -> Column:
    col = quoted(field.name)
    if expected == "string":
        return col.cast("string")
    if expected == "numeric" and isinstance(field.dataType, T.IntegralType):
        return col
    return to_double(col, field.dataType)


def coerce_types(df: DataFrame, expected: Mapping[str, str] = EXPECTED_TYPES) -> DataFrame:
    """Cast the named columns to `string`, `numeric` or `float`; bad numbers become null."""
    return df.select(
        *[
            (_coerced(f, expected[f.name]) if f.name in expected else quoted(f.name)).alias(f.name)
            for f in df.schema.fields
        ]
    )


def _is_lost(field: T.StructField, expected: str) -> Column:
    raw = quoted(field.name)
    return ~_missing(raw, field.dataType) & _coerced(field, expected).isNull()


def coercion_losses(df: DataFrame, expected: Mapping[str, str] = EXPECTED_TYPES) -> DataFrame:
    """Per column: how many values the coercion turns into null."""
    fields = [f for f in df.schema.fields if f.name in expected]
    wide = df.agg(
        *[F.count_if(_is_lost(f, expected[f.name])).alias(f"_{i}") for i, f in enumerate(fields)]
    )
    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(expected[f.name]).alias("expected"),
            F.col(f"_{i}").alias("lost"),
        )
        for i, f in enumerate(fields)
    ]
    return wide.select(F.inline(F.array(*rows)))


# --- ranges ----------------------------------------------------------------


def _outside(
    df: DataFrame, column: str, limits: tuple[float | None, float | None]
) -> tuple[Column, Column]:
    """(below the minimum, above the maximum); null and NaN are neither."""
    value = nan_to_null(F.col(column), df.schema[column].dataType)
    low, high = limits
    below = F.lit(False) if low is None else F.coalesce(value < low, F.lit(False))
    above = F.lit(False) if high is None else F.coalesce(value > high, F.lit(False))
    return below, above


def out_of_range(df: DataFrame, ranges: Ranges = RANGES) -> Column:
    """True where any column violates its range."""
    checks = [c for name, lim in ranges.items() if name in df.columns for c in _outside(df, name, lim)]
    return reduce(Column.__or__, checks, F.lit(False))


def keep_in_range(df: DataFrame, ranges: Ranges = RANGES) -> DataFrame:
    return df.filter(~out_of_range(df, ranges))


def flag_out_of_range(
    df: DataFrame, ranges: Ranges = RANGES, flag: str = "out_of_range"
) -> DataFrame:
    """Keep all rows and mark the violating ones."""
    return df.withColumn(flag, out_of_range(df, ranges))


def range_report(df: DataFrame, ranges: Ranges = RANGES) -> DataFrame:
    """Per column the values below and above, and the rows any column would remove."""
    names = [c for c in ranges if c in df.columns]
    counters = [F.count_if(out_of_range(df, ranges)).alias("rows_removed")]
    rows = []
    for i, name in enumerate(names):
        below, above = _outside(df, name, ranges[name])
        counters += [F.count_if(below).alias(f"_below_{i}"), F.count_if(above).alias(f"_above_{i}")]
        rows.append(
            F.struct(
                F.lit(name).alias("column"),
                F.col(f"_below_{i}").alias("below"),
                F.col(f"_above_{i}").alias("above"),
                (F.col(f"_below_{i}") + F.col(f"_above_{i}")).alias("violations"),
                F.col("rows_removed"),
            )
        )
    return df.agg(*counters).select(F.inline(F.array(*rows)))


# --- duplicates ------------------------------------------------------------


def _order(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], last: bool
) -> list[Column]:
    """The given order, then every other sortable column, so that ties are equal rows."""
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in {*keys, *order_by}
        and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    cols = [quoted(c) for c in [*order_by, *rest]] or [F.lit(0)]
    return [c.desc_nulls_last() if last else c.asc_nulls_first() for c in cols]


def deduplicate(
    df: DataFrame,
    keys: Sequence[str] = DUPLICATE_KEY,
    keep: str | bool = "first",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the first or last by the given order, or none of a repeated key.

    Null keys count as equal. Rows have no position in Spark, so the order is
    explicit. Keeping one row filters on `row_number() = 1`, which Spark also
    applies before the shuffle: a key that holds a third of the rows sends one
    row per task. Dropping all copies counts with a map-side aggregate.
    """
    if keep in ("first", "last"):
        window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(
            *_order(df, keys, order_by, keep == "last")
        )
        return (
            df.withColumn("_position", F.row_number().over(window))
            .filter(F.col("_position") == 1)
            .drop("_position")
        )
    if keep is not False and keep != "none":
        raise ValueError(f"keep must be 'first', 'last' or False: {keep!r}")
    row = F.struct(*[quoted(c) for c in df.columns])
    return (
        df.groupBy(*[quoted(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
        .agg(F.count(F.lit(1)).alias("_copies"), F.first(row).alias("_row"))
        .filter(F.col("_copies") == 1)
        .select("_row.*")
    )


def duplicate_counts(
    df: DataFrame, keys: Sequence[str] = DUPLICATE_KEY, keep: str | bool = "first"
) -> DataFrame:
    """Rows, rows that share a key, groups of them, rows a removal takes away."""
    per_key = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    shared = F.when(F.col("_n") > 1, F.col("_n"))
    spare = 1 if keep in ("first", "last") else 0
    return per_key.agg(
        _total("_n").alias("rows"),
        _total(shared).alias("rows_involved"),
        F.count(shared).alias("groups"),
        _total(shared - spare).alias("rows_to_remove"),
    )


def repeated_keys(df: DataFrame, keys: Sequence[str] = ("school_id",)) -> DataFrame:
    """Keys that break uniqueness, with their number of rows. Empty when the key is unique."""
    return (
        df.groupBy(*[quoted(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


# --- all checks together ---------------------------------------------------


def validate(
    df: DataFrame,
    order_by: Sequence[str] = (),
    remove_out_of_range: bool = True,
    remove_duplicates: bool = True,
    ranges: Ranges = RANGES,
    keys: Sequence[str] = DUPLICATE_KEY,
    expected: Mapping[str, str] = EXPECTED_TYPES,
) -> DataFrame:
    """The rows that pass: types coerced, ranges kept, then one row per key.

    The order matters: a first occurrence that is out of range is gone before
    the keys are compared, so the second one survives.
    """
    rows = coerce_types(require_columns(df), expected)
    if remove_out_of_range:
        rows = keep_in_range(rows, ranges)
    return deduplicate(rows, keys, "first", order_by) if remove_duplicates else rows


def validation_counts(
    df: DataFrame,
    remove_out_of_range: bool = True,
    remove_duplicates: bool = True,
    ranges: Ranges = RANGES,
    keys: Sequence[str] = DUPLICATE_KEY,
    expected: Mapping[str, str] = EXPECTED_TYPES,
) -> DataFrame:
    """Row counts of `validate` in one row, without making its rows.

    Per key only two numbers are shuffled, after a map-side sum.
    """
    rows = coerce_types(df, expected)
    kept = ~out_of_range(rows, ranges) if remove_out_of_range else F.lit(True)
    per_key = rows.groupBy(*[quoted(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(kept).alias("_kept")
    )
    copies = F.when(F.col("_kept") > 1, F.col("_kept"))
    counts = per_key.agg(
        _total("_rows").alias("rows"),
        _total("_kept").alias("in_range"),
        _total(copies).alias("rows_sharing_a_key"),
        _total(copies - 1).alias("duplicates"),
    )
    spare = F.col("duplicates") if remove_duplicates else F.lit(0)
    return counts.withColumn("validated", F.col("in_range") - spare)


def _line(
    severity: str, check: str, column: str, affected: Column, detail: Column | str
) -> Column:
    return F.struct(
        F.lit(severity).alias("severity"),
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        affected.cast("bigint").alias("affected_rows"),
        (F.lit(detail) if isinstance(detail, str) else detail).alias("detail"),
    )


def _lines(counts: DataFrame, lines: Sequence[Column]) -> DataFrame:
    """The lines that are not null, from a row of counts."""
    return counts.select(F.inline(F.filter(F.array(*lines), lambda x: x.isNotNull())))


def _value_lines(
    df: DataFrame,
    remove_out_of_range: bool,
    ranges: Ranges,
    expected: Mapping[str, str],
    critical: Sequence[str],
    threshold: float,
) -> DataFrame:
    """Findings about single rows: nulls, lost values, ranges. One aggregate, no shuffle of rows."""
    types = [f for f in df.schema.fields if f.name in expected]
    nulls = [c for c in critical if c in df.columns]
    checked = [c for c in ranges if c in df.columns]
    coerced = {f.name: _coerced(f, expected[f.name]) for f in types}
    # Each value is coerced once; beside it stands whether the raw one was missing.
    rows = df.select(
        *[coerced.get(c, quoted(c)).alias(c) for c in dict.fromkeys([*coerced, *checked])],
        *[
            _missing(quoted(c), df.schema[c].dataType).alias(f"_absent_{c}")
            for c in dict.fromkeys([*coerced, *nulls])
        ],
    )
    counters = [F.count(F.lit(1)).alias("_rows"), F.count_if(out_of_range(rows, ranges)).alias("_bad")]
    lines = []
    for i, c in enumerate(nulls):
        counters.append(F.count_if(F.col(f"_absent_{c}")).alias(f"_null_{i}"))
        n = F.col(f"_null_{i}")
        percent = F.coalesce(_percent(n, F.col("_rows")), F.lit(0.0))
        text = F.format_string("%.2f%% null", percent)
        lines.append(F.when(percent > threshold, _line(WARNING, "nulls", c, n, text)))
    for i, c in enumerate(coerced):
        lost = ~F.col(f"_absent_{c}") & F.col(c).isNull()
        counters.append(F.count_if(lost).alias(f"_lost_{i}"))
        n = F.col(f"_lost_{i}")
        lines.append(F.when(n > 0, _line(CORRECTION, "types", c, n, "values set to null")))
    for i, c in enumerate(checked):
        below, above = _outside(rows, c, ranges[c])
        counters.append(F.count_if(below | above).alias(f"_range_{i}"))
        n = F.col(f"_range_{i}")
        low, high = ranges[c]
        limits = f"outside {'' if low is None else low}..{'' if high is None else high}"
        lines.append(F.when(n > 0, _line(WARNING, "ranges", c, n, limits)))
    if remove_out_of_range:
        n = F.col("_bad")
        lines.append(F.when(n > 0, _line(CORRECTION, "ranges", "", n, "rows removed")))
    return _lines(rows.agg(*counters), lines)


def _key_lines(counts: DataFrame, keys: Sequence[str], remove_duplicates: bool) -> DataFrame:
    """Findings about keys, and the totals."""
    n, key = F.col("duplicates"), ",".join(keys)
    shared = F.format_string("%d rows share a key", F.col("rows_sharing_a_key"))
    lines = [F.when(n > 0, _line(WARNING, "duplicates", key, n, shared))]
    if remove_duplicates:
        lines.append(F.when(n > 0, _line(CORRECTION, "duplicates", key, n, "rows removed")))
    removed = F.col("rows") - F.col("validated")
    lines.append(_line(INFO, "total_rows", "", F.col("rows"), ""))
    lines.append(_line(INFO, "validated_rows", "", F.col("validated"), ""))
    lines.append(_line(INFO, "removed_rows", "", removed, ""))
    return _lines(counts, lines)


def validation_report(
    df: DataFrame,
    remove_out_of_range: bool = True,
    remove_duplicates: bool = True,
    ranges: Ranges = RANGES,
    keys: Sequence[str] = DUPLICATE_KEY,
    expected: Mapping[str, str] = EXPECTED_TYPES,
    critical: Sequence[str] = CRITICAL_COLUMNS,
    threshold: float = NULL_THRESHOLD_PERCENT,
    required: Sequence[str] = REQUIRED_COLUMNS,
) -> DataFrame:
    """What `validate` finds and does: (severity, check, column, affected_rows, detail).

    Two scans of the checked columns. Findings about single rows need no shuffle;
    only the key and two counts per key are shuffled for the rest, since most
    keys occur once and every further counter would travel with each of them.
    All counts are aggregates, exact whatever tasks are run again. With missing
    columns the report is a single error.
    """
    if missing := missing_columns(df, required):
        row = (ERROR, "schema", ",".join(missing), 0, "missing columns")
        return df.sparkSession.createDataFrame([row], REPORT)
    values = _value_lines(df, remove_out_of_range, ranges, expected, critical, threshold)
    counts = validation_counts(df, remove_out_of_range, remove_duplicates, ranges, keys, expected)
    return values.unionByName(_key_lines(counts, keys, remove_duplicates))


def report_summary(report: DataFrame) -> DataFrame:
    """Number of errors, warnings and corrections; valid when there is no error."""
    return report.agg(
        F.count_if(F.col("severity") == ERROR).alias("errors"),
        F.count_if(F.col("severity") == WARNING).alias("warnings"),
        F.count_if(F.col("severity") == CORRECTION).alias("corrections"),
    ).withColumn("is_valid", F.col("errors") == 0)


# --- distributions ---------------------------------------------------------


def class_shares(df: DataFrame, column: str = "size_category") -> DataFrame:
    """Rows and share of every class, null included.

    The whole is the sum of the classes' counts, a single number worked out from the
    same shuffle; the table is read once.
    """
    counts = df.groupBy(quoted(column)).agg(F.count(F.lit(1)).alias("rows"))
    whole = counts.agg(F.sum("rows")).scalar()
    return counts.select(quoted(column), "rows", F.round(F.col("rows") * 100.0 / whole, 6).alias("percent"))


def value_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, maximum, mean and number of the values that are neither null nor NaN."""
    wide = df.agg(
        *[
            f(F.when(~_missing(F.col(c), df.schema[c].dataType), F.col(c))).alias(f"_{name}_{i}")
            for i, c in enumerate(columns)
            for name, f in (("count", F.count), ("min", F.min), ("max", F.max), ("avg", F.avg))
        ]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"_count_{i}").alias("values"),
            F.col(f"_min_{i}").cast("double").alias("min"),
            F.col(f"_max_{i}").cast("double").alias("max"),
            F.col(f"_avg_{i}").alias("mean"),
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))
