"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A character no plain number has: any letter but the exponent's, and control
# characters that are no blanks. The cast alone would take `1d`, `0x1p3`, `NaN`.
_NOT_PLAIN = r"[A-DF-Za-df-z\x00-\x08\x0e-\x1b]"

# The expressions below name their input as few times as they can: a filter on a
# derived column is pushed towards the scan with the whole expression, so every
# further mention is computed again there.


def nan_to_null(col: Column, dtype: T.DataType) -> Column:
    """Spark sorts NaN above every number; as null it is missing, as it should be."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(col, F.lit(None).cast(dtype))
    return col


def to_double(col: Column, dtype: T.DataType) -> Column:
    """A double, or null where the value is not a plain number. NaN counts as missing.

    Text may have blanks around the number (of the ASCII kind; `strip` removes others).
    """
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return nan_to_null(col, dtype).cast("double")
    text = col.cast("string")
    return F.when(~text.rlike(_NOT_PLAIN), text.try_cast("double"))


def to_long(col: Column, dtype: T.DataType) -> Column:
    """A whole number, or null: `12`, `12.0` and `1e3` pass, `3.5` does not."""
    if isinstance(dtype, T.IntegralType):
        return col.cast("bigint")
    number = to_double(col, dtype)
    whole = F.when(number == F.floor(number), number.try_cast("bigint"))
    if isinstance(dtype, T.StringType):
        return F.coalesce(col.try_cast("bigint"), whole)
    return whole


def steady_avg(col: Column, places: int = 10) -> Column:
    """Average, rounded far below the shown digits.

    The last bits of a sum of doubles depend on the order in which tasks end.
    Without the rounding a rank, a tier or a printed digit could differ between
    two runs over the same data.
    """
    return F.round(F.avg(col), places)


def as_percent(rate: Column) -> Column:
    """A rate in 0..1 as DECIMAL(5,2) percent, halves rounded up."""
    return F.round(rate * 100, 6).cast("decimal(5,2)")


def share_of(part: Column, whole: Column) -> Column:
    """part / whole in percent as DECIMAL(5,2), null when the whole is 0."""
    return F.try_divide(part.cast("decimal(20,0)") * 100, whole.cast("decimal(20,0)")).cast(
        "decimal(5,2)"
    )


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as DECIMAL(10,2), null unless the bottom is positive.

    Two digits more than a percentage needs: a ratio may pass 999.99.
    """
    return F.when(bottom > 0, F.round(top / bottom, 6)).cast("decimal(10,2)")


def whole_part(col: Column) -> Column:
    """Drop the fraction (towards zero)."""
    return col.cast("int")


def attribute(col: Column) -> Column:
    """The group's single value, `*` when it has several."""
    return F.when(F.min(col) == F.max(col), F.min(col)).when(F.min(col).isNotNull(), F.lit("*"))


def linear_fit(y: Column, x: Column) -> list[Column]:
    """Least-squares line of y on x as aggregate columns, over rows that have both.

    The correlation is spelled out: `corr` raises where x or y never varies,
    this gives null.
    """
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return [
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.try_divide(F.covar_pop(y, x), spread).alias("correlation"),
        F.regr_count(y, x).alias("points"),
    ]
