"""Intermediate tables in the shared folder: written once, read by every later step, safe from lost executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.session import shared_dir


#: For rows of megabytes: a row group for each, as a reader holds as many rows of a group at a time as it can get.
ROW_BY_ROW = {"parquet.block.size": 1 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}


#: Whether shuffle files go as soon as the query that made them has ended, not when the driver collects garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, purpose: str, compression: str = "snappy", options: dict | None = None) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read back; its shuffle files are freed."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.options(**(options or {})).parquet(path, compression=compression)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def set_aside(df: DataFrame, names: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with columns of these names out of the way, and what brings a result back to the columns of ``df``."""
    moved = {c: f"__own_{c}" for c in df.columns if c in names}
    back = lambda out: out.select(*(F.col(moved.get(c, c)).alias(c) for c in df.columns))
    return df.withColumnsRenamed(moved), back
