"""The staged run: records, validate, transform, load, with a log of each stage."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campusgrid.operators.clean import transform
from campusgrid.operators.quality import require_columns, validate, validation_counts
from campusgrid.sources.sinks import load_table, stamp

LOG = (
    "batch string, stage string, position int, status string, records_in bigint, "
    "records_out bigint, removed bigint, removed_percent double, seconds double, error string"
)


RECORDS_OUT = 5


def batch_id() -> str:
    """`YYYYMMDD_HHMMSS_xxxxxx`, the last part random."""
    return f"{stamp()}_{uuid.uuid4().hex[:6]}"


class RunFailed(Exception):
    """A stage failed. `log` holds the rows of all stages up to it."""

    def __init__(self, message: str, log: DataFrame):
        super().__init__(message)
        self.log = log


@dataclass
class StageLog:
    """Collects one row per stage."""

    spark: SparkSession
    batch: str
    rows: list[tuple]
    cause: Exception | None = None

    def stage(self, name: str, work: Callable[[], int]) -> bool:
        """Run one stage on what the last one left.

        An error, or no rows to work on, is logged and ends the run.
        """
        records_in = self.rows[-1][RECORDS_OUT] if self.rows else 0
        started, out, error = time.monotonic(), 0, None
        try:
            if self.rows and records_in == 0:
                raise ValueError(f"no rows to {name}")
            out = work()
        except Exception as failure:
            error, self.cause = f"{type(failure).__name__}: {failure}", failure
        removed = 0 if error else max(records_in - out, 0)
        self.rows.append(
            (
                self.batch,
                name,
                len(self.rows) + 1,
                "failed" if error else "success",
                records_in,
                out,
                removed,
                round(removed * 100.0 / records_in, 6) if records_in else 0.0,
                time.monotonic() - started,
                error,
            )
        )
        return error is None

    def table(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, LOG)


def run(
    records: DataFrame,
    folder: str,
    table: str,
    order_by: Sequence[str] = (),
    if_exists: str = "replace",
    table_path: str | None = None,
) -> DataFrame:
    """Run all stages below `folder` and return the log, one row per stage.

    The extract is written once and read back, so the later stages neither
    compute it again nor depend on the executors that made it. Validation counts
    over five of its columns; rows are only written when they are transformed.
    All counts come from those tables and that aggregate, so a task that runs
    twice is not counted twice. The first failing stage ends the run: it is logged, and
    `RunFailed` is raised with the log.
    """
    spark = records.sparkSession
    batch = batch_id()
    log = StageLog(spark, batch, [])
    staging, processed = f"{folder}/{batch}/staging", f"{folder}/{batch}/processed"

    def extract() -> int:
        records.write.mode("errorifexists").parquet(staging)
        return spark.read.parquet(staging).count()

    def check() -> int:
        return validation_counts(require_columns(spark.read.parquet(staging))).first().validated

    def change() -> int:
        rows = validate(spark.read.parquet(staging), order_by)
        rows.transform(transform).write.mode("errorifexists").parquet(processed)
        return spark.read.parquet(processed).count()

    def load() -> int:
        rows = spark.read.parquet(processed)
        return int(load_table(rows, table, if_exists, table_path)["rows_inserted"])

    for name, work in (
        ("extract", extract),
        ("validate", check),
        ("transform", change),
        ("load", load),
    ):
        if not log.stage(name, work):
            raise RunFailed(f"stage {name} failed: {log.rows[-1][-1]}", log.table()) from log.cause
    return log.table()


def run_summary(log: DataFrame) -> DataFrame:
    """One row per run: status, records extracted and loaded, seconds, the failed stage."""
    failed = F.col("status") == "failed"
    out_of = {s: F.when(F.col("stage") == s, F.col("records_out")) for s in ("extract", "load")}
    return log.groupBy("batch").agg(
        F.when(F.bool_or(failed), "failed").otherwise("success").alias("status"),
        F.coalesce(F.max(out_of["extract"]), F.lit(0)).alias("extracted"),
        F.coalesce(F.max(out_of["load"]), F.lit(0)).alias("loaded"),
        F.sum("seconds").alias("seconds"),
        F.max(F.when(failed, F.col("stage"))).alias("failed_stage"),
        F.max("error").alias("error"),
    )
