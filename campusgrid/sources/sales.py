"""Sales sheets exported as CSV or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from campusgrid.schema import INSTRUCTIONS, REIMBURSEMENTS
from campusgrid.sources.records import read_table


def read_instructions(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, INSTRUCTIONS)


def read_reimbursements(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, REIMBURSEMENTS)
