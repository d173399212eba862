"""Classifications. The limits of each are its own; they do not share one scale."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from campusgrid.schema import LARGE_ABOVE, SIZE_ORDER, SMALL_BELOW

# --- fixed values: (limit, label) pairs, checked in order -------------------

STATE_SELECTIVITY = ((0.30, "Highly Selective"), (0.50, "Selective"), (0.70, "Moderately Selective"))
STATE_SELECTIVITY_REST = "Open Admission"

STATE_COMPETITION = (
    (0.40, "Highly Competitive"),
    (0.60, "Competitive"),
    (0.80, "Moderately Competitive"),
)
STATE_COMPETITION_REST = "Accessible"

STATE_PERFORMANCE = ((0.65, "Top Performing"), (0.50, "Above Average"), (0.40, "Average"))
STATE_PERFORMANCE_REST = "Below Average"

SCHOOL_SELECTIVITY = (
    (0.25, "Highly Selective (<25%)"),
    (0.50, "Selective (25-50%)"),
    (0.75, "Moderately Selective (50-75%)"),
)
SCHOOL_SELECTIVITY_REST = "Open Admission (75%+)"

SCHOOL_COMPLETION = (
    (0.80, "Excellent (80%+)"),
    (0.60, "Good (60-80%)"),
    (0.40, "Moderate (40-60%)"),
)
SCHOOL_COMPLETION_REST = "Low (<40%)"
NO_DATA = "No Data"

HIGH_PERFORMERS = ((0.90, "Elite (90%+)"), (0.80, "Excellent (80-90%)"))
HIGH_PERFORMERS_REST = "Other"

# --- expressions -----------------------------------------------------------


def _cases(pairs: Sequence[tuple[Column, object]], rest: object) -> Column:
    (condition, value), *more = pairs
    out = F.when(condition, value)
    for condition, value in more:
        out = out.when(condition, value)
    return out.otherwise(rest)


def below(value: Column, limits: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the first limit the value is below. A null value gets `rest`."""
    return _cases([(value < limit, label) for limit, label in limits], rest)


def at_least(value: Column, limits: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the first limit the value reaches. A null value gets `rest`."""
    return _cases([(value >= limit, label) for limit, label in limits], rest)


def size_category(
    size: Column, small_below: float = SMALL_BELOW, large_above: float = LARGE_ABOVE
) -> Column:
    """small < 5000, medium up to 15000 inclusive, large above; null stays null."""
    return (
        F.when(size < small_below, "small")
        .when(size <= large_above, "medium")
        .when(size > large_above, "large")
    )


def size_position(category: Column) -> Column:
    """Display order: large 1, medium 2, small 3, anything else 4."""
    positions = [(category == name, i) for i, name in enumerate(SIZE_ORDER, start=1)]
    return _cases(positions, len(SIZE_ORDER) + 1)


def code_label(code: Column, labels: Mapping[int, str]) -> Column:
    """Label of a code; an unknown code gives null."""
    return _cases([(code == key, label) for key, label in labels.items()], None)


def rate_profile(admission: Column, completion: Column) -> Column:
    """How admission and completion go together."""
    selective, open_ = admission < 0.30, admission >= 0.70
    return (
        F.when(selective & (completion > 0.80), "Selective + High Completion")
        .when(open_ & (completion > 0.70), "Open + High Completion")
        .when(selective & (completion < 0.50), "Selective + Low Completion")
        .when(open_ & (completion < 0.40), "Open + Low Completion")
        .otherwise("Average")
    )


def profile_position(profile: Column) -> Column:
    return (
        F.when(profile == "Selective + High Completion", 1)
        .when(profile == "Open + High Completion", 2)
        .otherwise(3)
    )
