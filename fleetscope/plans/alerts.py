"""Alert detectors as batch queries at a given time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.functions.timecols import seconds_between, trailing_partitions, ts_lit


def tamper_alert(events: DataFrame, as_of, interval: str = "1 MINUTE") -> DataFrame:
    """Locks with a tamper event in the last minute."""
    recent = trailing_partitions(events, "event_time", as_of, interval, strict=True)
    return (
        recent.filter(F.col("event_type") == "tamper_detected")
        .groupBy("lock_id")
        .agg(F.count("*").alias("tamper_events"), F.max("event_time").alias("last_event"))
    )


def last_status(status_changes: DataFrame, as_of) -> DataFrame:
    """The status of each lock at ``as_of`` and since when its latest change holds."""
    at = F.struct("change_time", "id")
    return (
        status_changes.filter(F.col("change_time") <= ts_lit(as_of))
        .groupBy("lock_id")
        .agg(F.max_by("status", at).alias("status"), F.max("change_time").alias("since"))
    )


def mass_offline_alert(
    locks: DataFrame, status_changes: DataFrame, as_of, interval: str = "5 MINUTES", share: float = 0.2
) -> DataFrame:
    """One row: locks that went offline within the interval, as a share of all known locks."""
    lately = trailing_partitions(last_status(status_changes, as_of), "since", as_of, interval)
    offline = lately.filter(F.col("status") == "offline").select(F.col("lock_id").alias("id"), F.lit(1).alias("off"))
    return _share(locks, offline, "offline_locks", share)


def battery_alert(locks: DataFrame, events: DataFrame, as_of, interval: str = "1 DAY", share: float = 0.2) -> DataFrame:
    """One row: locks with a battery_low event, as a share of all known locks."""
    low = trailing_partitions(events, "event_time", as_of, interval).filter(F.col("event_type") == "battery_low")
    low = low.select(F.col("lock_id").alias("id")).distinct().withColumn("off", F.lit(1))
    return _share(locks, low, "battery_low_locks", share)


def _share(locks: DataFrame, hits: DataFrame, name: str, limit: float) -> DataFrame:
    counted = locks.select("id").join(hits, "id", "left").agg(
        F.count("*").alias("locks"), F.count("off").alias(name)
    )
    part = F.col(name) / F.col("locks")
    return counted.select("locks", name, F.round(part, 4).alias("share"), (part > limit).alias("alert"))


def critical_burst_alert(
    events: DataFrame, n: int = 5, window: str = "10 minutes", slide: str = "1 minute"
) -> DataFrame:
    """Sliding windows with more than ``n`` critical events."""
    return (
        events.filter(F.col("severity") == "critical")
        .groupBy(F.window("event_time", window, slide).alias("w"))
        .agg(F.count("*").alias("critical_events"))
        .filter(F.col("critical_events") > n)
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "critical_events")
    )


def long_offline_alert(status_changes: DataFrame, as_of, minutes: int = 30) -> DataFrame:
    """Locks whose latest status is offline for longer than the given minutes."""
    limit = ts_lit(as_of) - F.expr(f"INTERVAL {minutes} MINUTES")
    return (
        last_status(status_changes, as_of)
        .filter((F.col("status") == "offline") & (F.col("since") < limit))
        .select("lock_id", F.col("since").alias("offline_since"), seconds_between(ts_lit(as_of), "since").alias("offline_seconds"))
    )
