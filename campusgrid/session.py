"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def session(app_name: str = "campusgrid", **settings: str) -> SparkSession:
    """A session with the settings the plans here count on.

    Adaptive execution splits skewed join partitions and sizes shuffle
    partitions; `forceOptimizeSkewedJoin` lets it do so even when that costs a
    second shuffle, which is cheaper than one task with a third of the rows.
    Time zone UTC makes stamps comparable between machines.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Shuffle files are deleted when the command that made them ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes in here give back the disk of their shuffles as soon as they end.

    Otherwise it stays taken until the driver happens to collect garbage. Only for writes:
    a DataFrame that is run twice would have to shuffle twice.
    """
    own = spark.conf.get(FREE_SHUFFLES, "false") != "true"
    if own:
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if own:
            spark.conf.set(FREE_SHUFFLES, "false")


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder every executor can reach.

    It lies below `spark.checkpoint.dir`. Without that setting only a local master
    gets one, below the warehouse.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir")
    return os.path.join(shared, f"campusgrid-{uuid.uuid4().hex}")
