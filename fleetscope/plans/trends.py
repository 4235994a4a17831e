"""Event trends over time. Facts are aggregated first; dimensions and global windows come after."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetscope import model
from fleetscope.functions.scoring import event_class, flag
from fleetscope.functions.timecols import date_key, day_of_week0, trailing, trailing_partitions, ts_lit

HOURLY = ["event_hour", "event_type", "severity"]


def hourly_counts(events: DataFrame) -> DataFrame:
    return (
        events.withColumn("event_hour", F.date_trunc("hour", "event_time"))
        .groupBy(*HOURLY)
        .agg(F.count("*").alias("event_count"))
    )


def hourly_event_trend(events: DataFrame, dim_date: DataFrame, dim_event_type: DataFrame) -> DataFrame:
    """Counts per hour, type and severity with date and category; dates outside the dimension drop.

    The hour decides the date, so both dimensions (fixed size) join the counts, not the facts.
    """
    return trend_view(hourly_counts(events), dim_date, dim_event_type)


def trend_view(counts: DataFrame, dim_date: DataFrame, dim_event_type: DataFrame) -> DataFrame:
    """Hourly counts with their date and category."""
    return (
        counts.withColumn("date_key", date_key("event_hour"))
        .join(F.broadcast(dim_date.select("date_key", F.col("full_date").alias("event_date"))), "date_key")
        .join(F.broadcast(dim_event_type.select("event_type", F.col("category").alias("event_category"))), "event_type")
        .select("event_hour", "event_date", "event_type", "event_category", "severity", "event_count")
    )


def trend_24h(trend: DataFrame, as_of) -> DataFrame:
    return (
        trend.filter(trailing("event_hour", as_of, "24 HOURS"))
        .select("event_hour", "event_type", "event_category", "severity", "event_count")
        .orderBy(F.desc("event_hour"), F.desc("event_count"), "event_type", "severity")
    )


def recent_hourly_trend(events: DataFrame, as_of) -> DataFrame:
    """The documented trend view: last 30 days, no dimensions."""
    return hourly_counts(trailing_partitions(events, "event_time", as_of, "30 DAYS", strict=True))


def daily_severity_30d(events: DataFrame, dim_date: DataFrame, as_of) -> DataFrame:
    midnight = F.date_trunc("day", ts_lit(as_of))
    day = F.to_date("event_time")
    counts = (
        trailing_partitions(events, "event_time", midnight, "30 DAYS")
        .groupBy(day.alias("full_date"), "severity")
        .agg(F.count("*").alias("event_count"))
    )
    return (
        counts.join(F.broadcast(dim_date.select("full_date")), "full_date", "left_semi")
        .select("full_date", "severity", "event_count")
        .orderBy(F.desc("full_date"), "severity")
    )


def top_types_7d(events: DataFrame, dim_event_type: DataFrame, as_of, approx: bool = False) -> DataFrame:
    """Counts and affected locks per type and severity.

    Events are first counted per lock, so the distinct count is a plain count over those groups and
    the one large shuffle carries at most one row per (type, severity, lock) and map task. With
    ``approx`` a sketch takes the place of the distinct count and even that shuffle goes away.
    """
    recent = trailing_partitions(events, "event_time", as_of, "7 DAYS")
    if approx:
        counted = recent.groupBy("event_type", "severity").agg(
            F.count("*").alias("event_count"), F.approx_count_distinct("lock_id").alias("affected_locks")
        )
    else:
        per_lock = recent.groupBy("event_type", "severity", "lock_id").agg(F.count("*").alias("n"))
        counted = per_lock.groupBy("event_type", "severity").agg(
            F.sum("n").alias("event_count"), F.count("*").alias("affected_locks")
        )
    return (
        counted.join(F.broadcast(dim_event_type.select("event_type", "category")), "event_type")
        .select("event_type", "category", "severity", "event_count", "affected_locks")
        .orderBy(F.desc("event_count"), "event_type", "severity")
    )


def _daily_locks(events: DataFrame) -> DataFrame:
    """Each lock once per type and day on which it has events."""
    timed = events.filter(F.col("event_time").isNotNull() & F.col("lock_id").isNotNull())
    return timed.select("event_type", "lock_id", F.to_date("event_time").alias("day")).distinct()


def _every_day(rows: DataFrame) -> DataFrame:
    """event_type and every day from its first to its last."""
    ends = rows.groupBy("event_type").agg(F.min("day").alias("a"), F.max("day").alias("b"))
    return ends.select("event_type", F.explode(F.sequence("a", "b")).alias("day"))


def rolling_affected(events: DataFrame, days: int = 7) -> DataFrame:
    """For every day and type, the locks with an event on it or the ``days`` - 1 days before, exactly.

    A lock counts from a day with events until ``days`` later or until its next such day, which takes over. So it
    is one step up and one down per day with events, and totals run over the days' sums: events are read
    once however long the window is, and no day is listed with the locks of others.
    """
    daily = _daily_locks(events)
    after = F.lead("day").over(Window.partitionBy("event_type", "lock_id").orderBy("day"))
    gone = F.least(F.coalesce(after, F.date_add("day", days)), F.date_add("day", days))
    ends = F.array(F.struct(F.col("day"), F.lit(1).alias("step")), F.struct(gone.alias("day"), F.lit(-1).alias("step")))
    steps = daily.withColumn("_ends", ends).select("event_type", F.inline("_ends")).groupBy("event_type", "day").agg(F.sum("step").alias("step"))
    lane = Window.partitionBy("event_type").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = _every_day(daily).join(steps, ["event_type", "day"], "left")  # days without steps carry the total on
    return summed.select("event_type", "day", F.sum(F.coalesce("step", F.lit(0))).over(lane).alias("affected_locks"))


def lock_sketches(events: DataFrame, lg_k: int = 12) -> DataFrame:
    """Per type and day a sketch of the locks with events, to be stored and merged over any days later."""
    timed = events.filter(F.col("event_time").isNotNull() & F.col("lock_id").isNotNull())
    return timed.groupBy("event_type", F.to_date("event_time").alias("day")).agg(F.hll_sketch_agg("lock_id", lg_k).alias("locks"))


def rolling_affected_approx(sketches: DataFrame, days: int = 7) -> DataFrame:
    """``rolling_affected`` from stored sketches; their relative error is about 1.04 / sqrt(2^lg_k), 1.6 % by default."""
    reach = F.sequence("day", F.date_add("day", days - 1))
    spread = sketches.select("event_type", F.explode(reach).alias("day"), "locks")
    merged = spread.groupBy("event_type", "day").agg(F.hll_union_agg("locks").alias("locks"))
    wanted = _every_day(sketches).join(merged, ["event_type", "day"], "left")
    return wanted.select("event_type", "day", F.coalesce(F.hll_sketch_estimate("locks"), F.lit(0)).alias("affected_locks"))


def heatmap(events: DataFrame) -> DataFrame:
    """Counts per hour of day, day of week (Sunday is 0) and severity."""
    return (
        events.groupBy(
            F.hour("event_time").alias("hour_of_day"),
            day_of_week0("event_time").alias("day_of_week"),
            "severity",
        )
        .agg(F.count("*").alias("event_count"))
        .orderBy("day_of_week", "hour_of_day", "severity")
    )


def critical_spikes(events: DataFrame, factor: float = 2.0, rows: int = 24) -> DataFrame:
    """Hours with more than ``factor`` times the average of the ``rows`` counted hours before.

    The window is global but runs over one row per hour. Hours without critical events have no row,
    so the average is over counted hours, not over the clock.
    """
    hourly = (
        events.filter(F.col("severity") == "critical")
        .groupBy(F.date_trunc("hour", "event_time").alias("event_hour"))
        .agg(F.count("*").alias("critical_count"))
    )
    before = Window.orderBy("event_hour").rowsBetween(-rows, -1)
    average = F.col("_average")
    return (
        hourly.withColumn("_average", F.avg("critical_count").over(before))
        .filter((average > 0) & (F.col("critical_count") > factor * average))
        .select(
            "event_hour",
            "critical_count",
            F.round(average, 2).alias("rolling_avg_24h"),
            F.round(F.col("critical_count") / average, 2).alias("spike_ratio"),
        )
        .orderBy(F.desc("event_hour"))
    )


def event_severity_rollup(events: DataFrame, as_of=None) -> DataFrame:
    """The hourly rollup table; its writer sorts within partitions, a global order is not kept."""
    return hourly_counts(events).select(
        "event_hour",
        "event_type",
        "severity",
        "event_count",
        date_key("event_hour").alias("date_key"),
        ts_lit(as_of).alias("calculated_at"),
    )


def agg_hourly_event_counts(events: DataFrame) -> DataFrame:
    return (
        events.groupBy(
            date_key("event_time").alias("date_key"),
            F.hour("event_time").alias("hour"),
            "event_type",
            "severity",
        )
        .agg(F.count("*").alias("event_count"))
    )


def events_per_minute(events: DataFrame, as_of, interval: str = "6 HOURS") -> DataFrame:
    recent = trailing_partitions(events, "event_time", as_of, interval)
    return (
        recent.groupBy(F.window("event_time", "1 minute").alias("w"))
        .agg(F.count("*").alias("event_count"))
        .select(F.col("w.start").alias("minute"), "event_count")
    )


def events_by_class(events: DataFrame) -> DataFrame:
    """Events per class, type and severity."""
    return (
        events.groupBy("event_type", "severity")
        .agg(F.count("*").alias("event_count"))
        .withColumn("event_class", event_class())
    )


def events_by_category(events: DataFrame, dim_event_type: DataFrame) -> DataFrame:
    per_type = events.groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum(flag(F.col("severity") == "critical")).alias("critical")
    )
    return (
        per_type.join(F.broadcast(dim_event_type.select("event_type", "category")), "event_type")
        .groupBy("category")
        .agg(F.sum("n").alias("event_count"), F.sum("critical").alias("critical_events"))
    )


def events_by_calendar(events: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Every day of the date dimension with its event count, 0 where none happened."""
    daily = events.groupBy(date_key("event_time").alias("date_key")).agg(F.count("*").alias("n"))
    return dim_date.join(daily, "date_key", "left").select(
        "date_key",
        "full_date",
        "year",
        "quarter",
        "month",
        "day",
        "week",
        "day_of_week",
        "is_weekend",
        F.coalesce("n", F.lit(0)).alias("event_count"),
    )


def lateness(arrivals: DataFrame, delay_minutes: int = 10) -> DataFrame:
    """How late events arrive, per severity: share late at all and share beyond the watermark delay."""
    late = F.unix_timestamp("ingest_time") - F.unix_timestamp("event_time")
    return (
        arrivals.withColumn("_late", late)
        .groupBy("severity")
        .agg(
            F.count("*").alias("event_count"),
            F.sum(flag(F.col("_late") > 0)).alias("late_events"),
            F.sum(flag(F.col("_late") > delay_minutes * 60)).alias("beyond_watermark"),
            F.max("_late").alias("max_late_seconds"),
        )
    )


def event_totals(events: DataFrame) -> DataFrame:
    """Events by type and severity."""
    return (
        events.groupBy("event_type", "severity")
        .agg(F.count("*").alias("total_events"))
        .orderBy(F.desc("total_events"), "event_type", "severity")
    )


def event_type_stats(events: DataFrame) -> DataFrame:
    return (
        events.groupBy("event_type", "severity")
        .agg(
            F.count("*").alias("total"),
            F.min("event_time").alias("first_event"),
            F.max("event_time").alias("last_event"),
        )
        .orderBy(F.desc("total"), "event_type", "severity")
    )


def events_by_severity(events: DataFrame, severity: str | None = None) -> DataFrame:
    """All events, or those of one severity."""
    if severity is None:
        return events
    if severity not in model.SEVERITIES:
        raise ValueError(f"unknown severity {severity!r}; known: {model.SEVERITIES}")
    return events.filter(F.col("severity") == severity)
