"""Event sequences per lock: consecutive events, running totals, patterns, ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.functions.scoring import severity_flag
from fleetscope.functions.timecols import seconds_between
from fleetscope.operators.ordered import dense_ranks, latest_per_key, over_history, rolling_count, running

ORDER = ["event_time", "id"]
_COLS = ["lock_id", "id", "event_type", "severity", "event_time"]


def _history(events: DataFrame, build, **reach) -> DataFrame:
    return over_history(events.select(*_COLS), "lock_id", ORDER, build, **reach)


def _counters() -> dict:
    return {"_one": F.lit(1).cast("bigint"), "_critical": severity_flag("critical")}


def latest_event_per_lock(events: DataFrame) -> DataFrame:
    return latest_per_key(events, "lock_id", ORDER, ["event_type", "severity", "event_time"])


def time_between_events(events: DataFrame) -> DataFrame:
    """Each event after the first with the type of and seconds since the one before."""
    pairs = _history(events, lambda w: {"_was": F.lag(F.struct("event_time", "event_type")).over(w)}, back=1)
    return pairs.filter(F.col("_was").isNotNull()).select(
        "lock_id",
        "event_type",
        "event_time",
        F.col("_was.event_type").alias("prev_event_type"),
        seconds_between("event_time", "_was.event_time").alias("seconds_since_prev"),
    )


def running_totals(events: DataFrame) -> DataFrame:
    counted = _history(
        events,
        lambda w: {"event_num": running("_one", w), "running_critical": running("_critical", w)},
        totals=_counters(),
    )
    return counted.select(
        "lock_id",
        "event_time",
        "event_type",
        "severity",
        "event_num",
        F.col("event_num").alias("running_total"),
        "running_critical",
    )


def rank_locks(events: DataFrame) -> DataFrame:
    per_lock = events.groupBy("lock_id").agg(F.count("*").alias("total_events"))
    ranked = dense_ranks(per_lock, "total_events")
    return ranked.select("lock_id", "total_events", "rank", "dense_rank").orderBy("rank", "lock_id")


def event_sequences(events: DataFrame) -> DataFrame:
    """Each event but the last with the type of and seconds to the next one."""
    pairs = _history(events, lambda w: {"_next": F.lead(F.struct("event_time", "event_type")).over(w)}, ahead=1)
    return pairs.filter(F.col("_next").isNotNull()).select(
        "lock_id",
        "event_type",
        "event_time",
        F.col("_next.event_type").alias("next_event_type"),
        seconds_between("_next.event_time", "event_time").alias("seconds_to_next"),
    )


def attack_pattern(events: DataFrame, first: str = "tamper_detected", second: str = "unlock_attempt") -> DataFrame:
    """Events of type ``first`` directly followed by one of type ``second``."""
    return event_sequences(events).filter(
        (F.col("event_type") == first) & (F.col("next_event_type") == second)
    )


def sliding(events: DataFrame, n: int = 3) -> DataFrame:
    """Rows and critical rows among the last ``n`` events of the lock, the current one included."""

    def build(w):
        frame = w.rowsBetween(-(n - 1), Window.currentRow)
        return {
            "events_in_window": F.count("*").over(frame),
            "critical_in_last_3": F.sum(severity_flag("critical")).over(frame),
        }

    counted = _history(events, build, back=n - 1)
    return counted.select(
        "lock_id", "event_time", "event_type", "severity", "events_in_window", "critical_in_last_3"
    )


def event_windows(events: DataFrame) -> DataFrame:
    """Sequence number, neighbours, running and sliding counts in one pass over each history."""

    def build(w):
        return {
            "event_num": running("_one", w),
            "prev_event": F.lag("event_type").over(w),
            "next_event": F.lead("event_type").over(w),
            "running_critical": running("_critical", w),
            "count_last_3": F.count("*").over(w.rowsBetween(-2, Window.currentRow)),
        }

    out = _history(events, build, back=2, ahead=1, totals=_counters())
    return out.select(
        "lock_id",
        "event_type",
        "severity",
        "event_time",
        "event_num",
        "prev_event",
        "next_event",
        "running_critical",
        "count_last_3",
    )


def events_last_hour(events: DataFrame, seconds: int = 3600) -> DataFrame:
    """Events of the lock in the last hour up to and including each event, by whole seconds."""
    timed = events.select(*_COLS).withColumn("_sec", F.unix_timestamp("event_time"))
    counted = rolling_count(timed, "lock_id", "_sec", seconds, "events_last_hour")
    return counted.select("lock_id", "id", "event_type", "event_time", "events_last_hour")
