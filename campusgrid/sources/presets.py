"""Column groups, row filters and named datasets over flat records.

All are plain `select` and `filter`, so both reach a Parquet scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campusgrid.functions.text import quoted
from campusgrid.schema import (
    DEFAULT_GROUPS,
    EXTENDED_FIELD_TO_COLUMN,
    EXTENDED_INTEGER_COLUMNS,
    FIELD_GROUPS,
    FIELD_TO_COLUMN,
    INTEGER_COLUMNS,
    LARGE_ENROLLMENT,
    PRESETS,
    STRING_COLUMNS,
)

# Filter argument -> record field.
FILTER_FIELDS = {
    "state": "school.state",
    "ownership": "school.ownership",
    "degree": "school.degrees_awarded.predominant",
}
SIZE_FIELD = "latest.student.size"
OPERATING_FIELD = "school.operating"


def group_fields(
    groups: Sequence[str] = (),
    fields: Sequence[str] = (),
    known: Mapping[str, Sequence[str]] = FIELD_GROUPS,
) -> list[str]:
    """Sorted union of the groups' fields and the extra fields; unknown groups are skipped."""
    wanted = {f for g in groups for f in known.get(g, ())} | set(fields)
    return sorted(wanted or {f for g in DEFAULT_GROUPS for f in known[g]})


def field_type(field: str) -> str:
    """The type of a record field: that of its column, else a number, as all fields of the
    groups beyond the columns are."""
    column = {**EXTENDED_FIELD_TO_COLUMN, **FIELD_TO_COLUMN}.get(field)
    if column in INTEGER_COLUMNS or column in EXTENDED_INTEGER_COLUMNS:
        return "bigint"
    return "string" if column in STRING_COLUMNS or not field.startswith("latest.") else "double"


def select_fields(
    df: DataFrame, groups: Sequence[str] = (), fields: Sequence[str] = ()
) -> DataFrame:
    """The columns of the groups. One that the table lacks is null, of the field's type."""
    return df.select(
        *[
            quoted(f) if f in df.columns else F.lit(None).cast(field_type(f)).alias(f)
            for f in group_fields(groups, fields)
        ]
    )


def row_filter(
    state: str | None = None,
    ownership: int | None = None,
    degree: int | None = None,
    min_size: int | None = None,
    operating: bool = False,
    equal: Mapping[str, Any] | None = None,
) -> Column:
    """All given conditions joined by and. A size limit of 0 or None means no limit."""
    given = {"state": state, "ownership": ownership, "degree": degree}
    conditions = [
        quoted(FILTER_FIELDS[name]) == value for name, value in given.items() if value is not None
    ]
    if min_size is not None and min_size > 0:
        conditions.append(quoted(SIZE_FIELD) >= min_size)
    if operating:
        conditions.append(quoted(OPERATING_FIELD) == 1)
    conditions += [quoted(field) == value for field, value in (equal or {}).items()]
    return reduce(Column.__and__, conditions, F.lit(True))


def fetch(
    df: DataFrame, groups: Sequence[str] = (), fields: Sequence[str] = (), **filters: Any
) -> DataFrame:
    """Filter rows, then keep the groups' columns."""
    return select_fields(df.filter(row_filter(**filters)), groups, fields)


def preset(df: DataFrame, name: str, **filters: Any) -> DataFrame:
    """A named dataset; `by_state` needs a state."""
    if name not in PRESETS:
        raise ValueError(f"unknown dataset {name!r}, have {sorted(PRESETS)}")
    if name == "by_state" and not filters.get("state"):
        raise ValueError("by_state needs a state")
    groups, fixed = PRESETS[name]
    return fetch(df, groups, **{**fixed, **filters})


def all_institutions(
    df: DataFrame, demographics: bool = True, costs: bool = True, outcomes: bool = True
) -> DataFrame:
    chosen = {"demographics": demographics, "cost": costs, "outcomes": outcomes}
    return fetch(df, [*DEFAULT_GROUPS, *[g for g, on in chosen.items() if on]])


def by_state(df: DataFrame, state: str, **more: Any) -> DataFrame:
    return fetch(df, state=state, **more)


def large_institutions(
    df: DataFrame, min_size: int = LARGE_ENROLLMENT, **more: Any
) -> DataFrame:
    return fetch(df, min_size=min_size, **more)


def count_matching(df: DataFrame, operating: bool = True, **filters: Any) -> int:
    """Rows that match; only the filter columns are read."""
    return df.filter(row_filter(operating=operating, **filters)).count()


def first_pages(
    df: DataFrame,
    order_by: Sequence[str],
    pages: int | None = None,
    page_size: int = 100,
    max_records: int | None = None,
) -> DataFrame:
    """The first rows by the given order, as many as the pages or the record limit hold.

    The order makes the sample the same on each run; end it with a unique column.
    """
    limits = [n for n in (pages and pages * page_size, max_records) if n]
    return df.orderBy(*[quoted(c) for c in order_by]).limit(min(limits)) if limits else df
