"""Column helpers for time keys and trailing filters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ts_lit(value: datetime | str | Column | None) -> Column:
    """``as_of`` in any accepted form as a timestamp column; None means now."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp")


def from_millis(col) -> Column:
    return F.timestamp_millis(col)


def date_key(col) -> Column:
    return F.date_format(col, "yyyyMMdd").cast("int")


def with_date_key(df: DataFrame, ts_col: str, out: str = "date_key") -> DataFrame:
    return df.withColumn(out, date_key(ts_col))


def day_of_week0(col) -> Column:
    """Day of week with Sunday as 0."""
    return F.dayofweek(col) - F.lit(1)


def seconds_between(later, earlier) -> Column:
    """Whole seconds from ``earlier`` to ``later``; both are truncated to seconds first."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def trailing(col: str, as_of, interval: str, strict: bool = False) -> Column:
    """Rows not older than ``interval`` before ``as_of``; ``strict`` leaves the limit itself out."""
    limit = ts_lit(as_of) - F.expr(f"INTERVAL {interval}")
    return F.col(col) > limit if strict else F.col(col) >= limit


def trailing_partitions(df: DataFrame, col: str, as_of, interval: str, strict: bool = False) -> DataFrame:
    """``trailing`` plus the implied ``date_key`` bound where the table is partitioned by it."""
    df = df.filter(trailing(col, as_of, interval, strict))
    if "date_key" in df.columns:
        df = df.filter(F.col("date_key") >= date_key(ts_lit(as_of) - F.expr(f"INTERVAL {interval}")))
    return df
