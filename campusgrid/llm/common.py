"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from campusgrid.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1)).cast("int")


def written(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows from a table in the shared scratch folder, which outlives lost executors."""
    spark = df.sparkSession
    folder = folder or scratch_dir(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
