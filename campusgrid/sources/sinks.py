"""Writers: raw JSON, staging, processed CSV, tables."""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campusgrid.functions.text import quoted
from campusgrid.sources import codec

TABLE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}
BATCH_ROWS = 500

class LoadError(Exception):
    """The target cannot take the rows."""


def stamp(pattern: str = "%Y%m%d_%H%M%S") -> str:
    return datetime.now(timezone.utc).strftime(pattern)


def write_raw_json(records: DataFrame, root: str, name: str, at: str | None = None) -> str:
    """Records as JSON lines in a new folder, their types beside them; an existing one is
    never touched. Stamps keep six digits."""
    path = f"{root}/{name}_{at or stamp()}.json"
    records.write.mode("errorifexists").options(**codec.STAMPS, ignoreNullFields=False).json(path)
    codec.write_schema(records.sparkSession, path, records.schema)
    return path


def write_csv(df: DataFrame, path: str, compressed: bool = False, portion_by: str | None = None) -> str:
    """Rows as text that `records.read_table` gives back as they are.

    Large tables should be compressed, and those that come out of joins by large keys
    written in portions: see `codec.write`.
    """
    return codec.write(df, path, compressed, portion_by)


def write_staging(df: DataFrame, root: str, name: str, at: str | None = None) -> tuple[str, str]:
    """The table as Parquet and as CSV. The CSV is made from the Parquet, not computed again."""
    base = f"{root}/{name}_{at or stamp()}"
    df.write.mode("errorifexists").parquet(f"{base}.parquet")
    write_csv(df.sparkSession.read.parquet(f"{base}.parquet"), f"{base}.csv")
    return f"{base}.parquet", f"{base}.csv"


def write_processed(
    df: DataFrame, root: str, prefix: str = "processed", at: str | None = None
) -> str:
    """The transformed table as CSV `{prefix}_YYYY_MM_DD_HHMMSS.csv`."""
    return write_csv(df, f"{root}/{prefix}_{at or stamp('%Y_%m_%d_%H%M%S')}.csv")


def table_rows(spark: SparkSession, table: str) -> int:
    """Rows of a table, 0 when it does not exist."""
    return spark.table(table).count() if spark.catalog.tableExists(table) else 0


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def load_table(
    df: DataFrame,
    table: str,
    if_exists: str = "replace",
    path: str | None = None,
    partition_by: tuple[str, ...] = (),
) -> dict[str, object]:
    """Write a table and report its row counts before and after.

    Both counts come from the Parquet footers. An empty input is refused before
    anything is written; that look starts the plan of `df` once more, so give it
    rows read from a written table, as the staged run does.
    """
    if if_exists not in TABLE_MODES:
        raise ValueError(f"if_exists must be one of {sorted(TABLE_MODES)}")
    spark = df.sparkSession
    if df.isEmpty():
        raise LoadError("nothing to load: the input has no rows")
    if if_exists == "fail" and spark.catalog.tableExists(table):
        raise LoadError(f"table exists: {table}")
    before = table_rows(spark, table)
    writer = df.write.mode(TABLE_MODES[if_exists]).format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    started = time.monotonic()
    writer.saveAsTable(table)
    seconds = time.monotonic() - started
    after = table_rows(spark, table)
    return {
        "table_name": table,
        "rows_before": before,
        "rows_after": after,
        "rows_inserted": after - before if if_exists == "append" else after,
        "duration_seconds": seconds,
        "status": "success",
    }


def for_database(df: DataFrame) -> DataFrame:
    """Types every database takes: stamps and dates as text, NaN as null."""
    out = []
    for field in df.schema.fields:
        col = quoted(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            col = col.cast("string")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            col = F.when(~F.isnan(col), col)
        out.append(col.alias(field.name))
    return df.select(*out)


def load_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    if_exists: str = "replace",
    batch_rows: int = BATCH_ROWS,
    connections: int = 16,
    **properties: str,
) -> None:
    """Write to a database in batches, over at most `connections` connections.

    A task that is run again after a lost executor may insert its rows twice;
    load into an empty table of its own and swap it in.
    """
    (
        for_database(df)
        .write.mode(TABLE_MODES[if_exists])
        .option("batchsize", batch_rows)
        .option("numPartitions", connections)
        .jdbc(url, table, properties=properties)
    )
