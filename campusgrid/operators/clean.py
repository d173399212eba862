"""Names, values and derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.functions.classes import size_category
from campusgrid.functions.numbers import nan_to_null, to_double
from campusgrid.functions.text import (
    BLANKS,
    clean_text,
    null_tokens,
    quoted,
    repeated,
    snake_case,
    state_code,
    strip,
)
from campusgrid.schema import (
    NON_NEGATIVE_COLUMNS,
    NUMERIC_EXPECTED,
    RATE_RENAMES,
    STATE_NULL_TOKENS,
)

STATE = "school_state"


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


# --- names -----------------------------------------------------------------


def standardize_columns(
    df: DataFrame, renames: Mapping[str, str] = RATE_RENAMES
) -> DataFrame:
    """Snake-case names, then the given renames. Two columns with one name are an error."""
    names = [snake_case(c) for c in df.columns]
    names = [renames.get(n, n) for n in names]
    if twice := repeated(names):
        raise ValueError(f"columns share a name: {twice}")
    return df.select(*[quoted(c).alias(n) for c, n in zip(df.columns, names)])


def prefix_columns(df: DataFrame, prefix: str, keep: Sequence[str]) -> DataFrame:
    """`NAME` becomes `{prefix}_NAME`, the kept columns stay as they are."""
    return df.select(
        *[quoted(c).alias(c if c in keep else f"{prefix}_{c}") for c in df.columns]
    )


# --- values ----------------------------------------------------------------


def clean_strings(df: DataFrame, without: Sequence[str] = ()) -> DataFrame:
    """Trim every text column and turn spelled-out nulls into null.

    Two steps, so that the trimmed text is made once and then compared.
    """
    names = [c for c in text_columns(df) if c not in without]
    trimmed = df.withColumns({c: strip(quoted(c)) for c in names})
    return trimmed.withColumns({c: null_tokens(quoted(c)) for c in names})


def clean_states(df: DataFrame, column: str = STATE) -> DataFrame:
    """Upper-case state codes without blanks; spelled-out nulls become null."""
    if column not in df.columns:
        return df
    upper = df.withColumn(column, F.upper(strip(F.col(column))))
    return upper.withColumn(column, null_tokens(F.col(column), STATE_NULL_TOKENS))


def clean_numbers(df: DataFrame, columns: Sequence[str] = NUMERIC_EXPECTED) -> DataFrame:
    """Text in number columns to double, bad values to null; NaN to null in every column."""
    out = []
    for field in df.schema.fields:
        col = quoted(field.name)
        if field.name in columns and isinstance(field.dataType, T.StringType):
            col = to_double(F.btrim(col, F.lit(BLANKS)), field.dataType)
        else:
            col = nan_to_null(col, field.dataType)
        out.append(col.alias(field.name))
    return df.select(*out)


def clean(df: DataFrame, numbers: Sequence[str] = NUMERIC_EXPECTED) -> DataFrame:
    """Strings and states, then numbers, which trim their own text and know no tokens."""
    return clean_numbers(clean_states(clean_strings(df, without=numbers)), numbers)


def cleaning_counts(df: DataFrame) -> DataFrame:
    """What `clean` would change, as one row from one pass.

    `cells_trimmed` counts text cells with outer blanks; `states_changed` the
    state codes that change besides trimming; `odd_states` the codes that are
    not two letters long afterwards.
    """
    counters = [
        F.count_if(quoted(c) != strip(quoted(c))).alias(f"_{i}")
        for i, c in enumerate(text_columns(df))
    ]
    cells = reduce(Column.__add__, [F.col(f"_{i}") for i in range(len(counters))], F.lit(0))
    if STATE in df.columns:
        before, after = clean_text(F.col(STATE)), state_code(clean_text(F.col(STATE)))
        states = [F.count_if(before != after), F.count_if(F.length(after) != 2)]
    else:
        states = [F.lit(0).cast("bigint"), F.lit(0).cast("bigint")]
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        states[0].alias("states_changed"),
        states[1].alias("odd_states"),
        *counters,
    ).select("rows", cells.cast("bigint").alias("cells_trimmed"), "states_changed", "odd_states")


# --- derived columns -------------------------------------------------------


def add_percentages(df: DataFrame) -> DataFrame:
    """`admission_rate_percentage` and `completion_rate_percentage` where the rate exists."""
    rates = [c for c in ("admission_rate", "completion_rate") if c in df.columns]
    return df.withColumns({f"{c}_percentage": F.col(c) * 100 for c in rates})


def add_size_category(df: DataFrame, column: str = "student_size") -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn("size_category", size_category(F.col(column)))


def derive(df: DataFrame) -> DataFrame:
    return add_size_category(add_percentages(df))


# --- row removal -----------------------------------------------------------


def is_negative(df: DataFrame, columns: Sequence[str] = NON_NEGATIVE_COLUMNS) -> Column:
    """True where any of the existing columns is below 0; null is not negative."""
    checks = [F.coalesce(F.col(c) < 0, F.lit(False)) for c in columns if c in df.columns]
    return reduce(Column.__or__, checks, F.lit(False))


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One of each set of equal rows. Equal rows meet in the map-side aggregate first."""
    return df.dropDuplicates()


def drop_negatives(
    df: DataFrame, columns: Sequence[str] = NON_NEGATIVE_COLUMNS
) -> DataFrame:
    return df.filter(~is_negative(df, columns))


def integrity_counts(df: DataFrame) -> DataFrame:
    """Rows before, exact duplicates, negative rows among the distinct ones, rows after."""
    negative = is_negative(df)
    per_row = df.groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    return per_row.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates_removed"),
        F.count_if(negative).alias("negative_rows_removed"),
        F.count_if(~negative).alias("rows_after"),
    )


# --- the chain -------------------------------------------------------------


def transform(df: DataFrame, renames: Mapping[str, str] = RATE_RENAMES) -> DataFrame:
    """Names, values, derived columns, exact duplicates, negative rows, in this order.

    Everything up to the duplicates is one narrow stage. A percentage is negative
    where its rate is, so the last step looks at the rates.
    """
    negative = [c for c in NON_NEGATIVE_COLUMNS if not c.endswith("_percentage")]
    return (
        df.transform(standardize_columns, renames)
        .transform(clean)
        .transform(derive)
        .transform(drop_exact_duplicates)
        .transform(drop_negatives, negative)
    )
