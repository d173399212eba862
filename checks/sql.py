"""Pieces of SQL the oracles share."""

from __future__ import annotations

from checks.tables import INSTITUTIONS_SQL

SIZE_POSITION = "CASE size_category WHEN 'large' THEN 1 WHEN 'medium' THEN 2 WHEN 'small' THEN 3"


def inst(query: str) -> str:
    """A query over the institutions."""
    return f"WITH {INSTITUTIONS_SQL} {query}"


def pct(rate: str) -> str:
    """A rate as DECIMAL(5,2) percent; the text step keeps the shown digits when rounding."""
    return f"CAST(CAST(round(({rate}) * 100, 6) AS VARCHAR) AS DECIMAL(5,2))"


def avg(column: str, places: int = 10) -> str:
    return f"round(avg({column}), {places})"


def trunc(column: str) -> str:
    return f"CAST(trunc({avg(column, 6)}) AS INTEGER)"


def share(part: str, whole: str) -> str:
    return f"CAST(({part}) * 100.0 / ({whole}) AS DECIMAL(5,2))"


def ratio(top: str, bottom: str) -> str:
    return (
        f"CASE WHEN ({bottom}) > 0 THEN "
        f"CAST(CAST(round(({top}) / ({bottom}), 6) AS VARCHAR) AS DECIMAL(10,2)) END"
    )


def tally(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


def rates(column: str, prefix: str) -> str:
    return f"""{pct(avg(column))} AS avg_{prefix}_rate_pct,
      {pct(f"min({column})")} AS min_{prefix}_rate_pct,
      {pct(f"max({column})")} AS max_{prefix}_rate_pct,
      {pct(f"stddev_samp({column})")} AS stddev_{prefix}_rate_pct"""
