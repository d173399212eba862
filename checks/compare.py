"""Runs queries beside their SQL and compares schema and values, in any row order."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import time

import duckdb
from pyspark.sql import SparkSession

from checks.registry import ORACLES, ORDERS, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            connection.execute(
                f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
            )
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return format(value, "f")
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return value


def _kind(value: object) -> str:
    return type(value).__name__


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def difference(spark: SparkSession, sf_dir: str, name: str) -> tuple[str | None, int]:
    """What differs between a query and its SQL (None when they agree), and the rows."""
    df = QUERIES[name](spark, sf_dir)
    got_raw = df.collect()
    result = connect(sf_dir).execute(ORACLES[name])
    names = [c[0] for c in result.description]
    want_raw = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got_raw)
    if name in ORDERS:
        by, shown = ORDERS[name]
        listed = connect(sf_dir).execute(f"SELECT {', '.join(shown)} FROM ({ORACLES[name]}) ORDER BY {by}").fetchall()
        for place, (row, sequence) in enumerate(zip(got_raw, listed)):
            own = [_plain(row[c]) for c in shown]
            if own != [_plain(v) for v in sequence]:
                return f"row {place} in order: {own} != {sequence}", len(got_raw)
    got, want = _rows(df.columns, got_raw), _rows(names, want_raw)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}", len(got_raw)
    for i, name_ in enumerate(sorted(names)):
        kinds = [
            {_kind(r[c.index(name_)]) for r in rows} - {"NoneType"}
            for c, rows in ((df.columns, got_raw), (names, want_raw))
        ]
        if kinds[0] != kinds[1]:
            return f"types of {name_}: {kinds[0]} != {kinds[1]}", len(got_raw)
    for a, b in zip(got, want):
        if a != b:
            cells = [(c, x, y) for c, x, y in zip(sorted(names), a, b) if x != y]
            return f"first differing row: {cells[:6]}", len(got_raw)
    return None, len(got_raw)


def main(sf_dir: str, only: list[str]) -> int:
    """Print one line per query; returns the number that differ."""
    from campusgrid.session import session
    from checks import load_all

    load_all()
    spark = session("checks", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in QUERIES:
        if only and not any(name.startswith(o) for o in only):
            continue
        started = time.monotonic()
        try:
            if name in ORACLES:
                found, rows = difference(spark, sf_dir, name)
                text = f"ok {rows} rows" if found is None else f"DIFFERS {found}"
            else:
                text, found = f"rows {QUERIES[name](spark, sf_dir).count()}", None
        except Exception as error:
            found = text = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{name:36s} {time.monotonic() - started:6.2f}s  {text}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    import sys

    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
