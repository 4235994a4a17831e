"""Shipment health: the warehouse view, its dashboard form, and the operational and documented forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope import model
from fleetscope.functions.scoring import (
    flag,
    health_label,
    is_compromised,
    overall_status,
    penalty,
    score,
    severity_flag,
)
from fleetscope.functions.timecols import trailing_partitions, ts_lit
from fleetscope.operators.dims import current
from fleetscope.session import checkpointed


def shipment_health(
    dim_shipment: DataFrame,
    status_changes: DataFrame,
    events: DataFrame,
    locations: DataFrame,
    fanout: bool = True,
) -> DataFrame:
    """Health per current shipment.

    The view joins status rows, events and positions of each lock, so its counts multiply. With
    ``fanout`` those very numbers come out, but from per-lock counts multiplied after aggregation:
    facts are never joined to facts. Without it each event counts once per shipment.
    """
    per_lock_events = events.groupBy("lock_id").agg(
        F.count("*").alias("n"),
        F.sum(severity_flag("critical")).alias("critical"),
        F.sum(severity_flag("high")).alias("high"),
        F.sum(penalty()).alias("points"),
        F.max("event_time").alias("last_event"),
    )
    per_lock_positions = locations.groupBy("lock_id").agg(
        F.count("*").alias("positions"), F.max("update_time").alias("last_position")
    )
    per_pair = (
        status_changes.filter(F.col("shipment_id").isNotNull())
        .groupBy("shipment_id", "lock_id")
        .agg(F.count("*").alias("rows"))
    )
    pairs = per_pair.join(per_lock_events, "lock_id", "left").join(per_lock_positions, "lock_id", "left")
    return health_view(dim_shipment, multiplied(pairs, fanout), no_event=F.lit(1 if fanout else 0).cast("bigint"))


def multiplied(pairs: DataFrame, fanout: bool = True) -> DataFrame:
    """Totals per shipment from the counts of its locks: with ``fanout`` every event once per status row and position."""
    one = F.lit(1).cast("bigint")
    none = F.lit(0).cast("bigint")
    times = F.col("rows") * F.coalesce("positions", one) if fanout else one
    no_event = one if fanout else none
    return pairs.groupBy("shipment_id").agg(
        F.count("lock_id").alias("active_locks"),
        F.sum(times * F.coalesce("n", none)).alias("total_security_events"),
        F.sum(times * F.coalesce("critical", none)).alias("critical_events"),
        F.sum(times * F.coalesce("high", none)).alias("high_events"),
        F.max("last_event").alias("last_security_event"),
        F.max("last_position").alias("last_location_update"),
        F.sum(times * F.coalesce("points", no_event)).alias("points"),
    )


def health_view(dim_shipment: DataFrame, per_shipment: DataFrame, no_event: Column) -> DataFrame:
    """Every current shipment with its totals and score; one without locks has the points ``no_event``."""
    none = F.lit(0).cast("bigint")
    zero = lambda c: F.coalesce(c, none).alias(c)
    return (
        current(dim_shipment)
        .select("shipment_id", F.col("status").alias("shipment_status"))
        .join(per_shipment, "shipment_id", "left")
        .select(
            "shipment_id",
            "shipment_status",
            zero("active_locks"),
            zero("total_security_events"),
            zero("critical_events"),
            zero("high_events"),
            "last_security_event",
            "last_location_update",
            score(F.coalesce("points", no_event)).alias("health_score"),
        )
    )


def shipment_health_dashboard(health: DataFrame) -> DataFrame:
    """Health with its label, worst shipments first."""
    return health.withColumn("health_label", health_label()).orderBy(
        F.asc("health_score"), F.desc("critical_events"), F.asc("shipment_id")
    )


def api_shipment_health(
    shipments: DataFrame, assignments: DataFrame, locks: DataFrame, events: DataFrame, as_of
) -> DataFrame:
    """Operational health of every shipment that has active locks.

    Only events of compromised locks in the last hour count; critical types beat warning types.
    """
    active = assignments.filter(F.col("released_at").isNull()).select("shipment_pk", "lock_id").distinct()
    recent = (
        trailing_partitions(events, "event_time", as_of, "1 HOUR", strict=True)
        .groupBy("lock_id")
        .agg(
            F.sum(flag(F.col("event_type").isin(model.CRITICAL_EVENTS))).alias("critical"),
            F.sum(flag(F.col("event_type").isin(model.WARNING_EVENTS))).alias("warning"),
        )
    )
    states = locks.select(F.col("id").alias("lock_id"), flag(is_compromised()).alias("compromised"))
    # events only matter for compromised locks, so they meet the lock table before anything else
    lock_view = states.join(recent, "lock_id", "left").select(
        "lock_id",
        "compromised",
        *[(F.col("compromised") * F.coalesce(c, F.lit(0))).alias(c) for c in ("critical", "warning")],
    )
    return (
        active.join(lock_view, "lock_id")
        .groupBy("shipment_pk")
        .agg(
            F.count("*").alias("total_locks"),
            F.sum("compromised").alias("compromised_locks"),
            F.sum("critical").alias("critical_events_last_hour"),
            F.sum("warning").alias("warning"),
        )
        .join(shipments.select("shipment_pk", "shipment_id"), "shipment_pk")
        .select(
            "shipment_id",
            "total_locks",
            "compromised_locks",
            "critical_events_last_hour",
            overall_status(F.col("critical_events_last_hour"), F.col("warning")).alias("overall_status"),
        )
    )


def mv_shipment_health(assignments: DataFrame, locks: DataFrame, events: DataFrame, as_of) -> DataFrame:
    """The documented view form: events of all active locks, critical by severity.

    Rows multiply by assignments of the same lock and shipment, as in the documented join.
    """
    recent = (
        trailing_partitions(events, "event_time", as_of, "1 HOUR", strict=True)
        .groupBy("lock_id")
        .agg(
            F.sum(flag(F.col("severity").isin("critical", "high"))).alias("severe"),
            F.sum(flag(F.col("event_type").isin(model.CRITICAL_EVENTS))).alias("critical"),
            F.sum(flag(F.col("event_type").isin(model.WARNING_EVENTS))).alias("warning"),
        )
    )
    pairs = (
        assignments.filter(F.col("released_at").isNull())
        .groupBy("shipment_pk", "lock_id")
        .agg(F.count("*").alias("rows"))
    )
    states = locks.select(F.col("id").alias("lock_id"), flag(is_compromised()).alias("compromised"))
    many = lambda c: F.sum(F.col("rows") * F.coalesce(c, F.lit(0)))
    return (
        pairs.join(states, "lock_id")
        .join(recent, "lock_id", "left")
        .groupBy("shipment_pk")
        .agg(
            F.count("*").alias("total_locks"),
            F.sum("compromised").alias("compromised_locks"),
            many("severe").alias("critical_events_last_hour"),
            many("critical").alias("_critical"),
            many("warning").alias("_warning"),
        )
        .select(
            "shipment_pk",
            "total_locks",
            "compromised_locks",
            "critical_events_last_hour",
            overall_status(F.col("_critical"), F.col("_warning")).alias("overall_status"),
            ts_lit(as_of).alias("computed_at"),
        )
    )


def shipment_event_detail(
    events: DataFrame,
    event_types: DataFrame,
    status_changes: DataFrame,
    locations: DataFrame,
    shipment_id: str,
    n: int = 100,
) -> DataFrame:
    """The latest ``n`` events of a shipment's locks with the position each lock had then.

    Like the dashboard query, an event appears once per status row that ties its lock to the
    shipment. The top ``n`` are taken first; positions are then looked up by broadcasting those few
    rows and keeping the latest match per event, which aggregates on the map side, so the position
    history of a busy lock is scanned but never gathered.
    """
    ties = (
        status_changes.filter(F.col("shipment_id") == shipment_id)
        .groupBy("lock_id")
        .agg(F.count("*").alias("_rows"))
    )
    newest = (
        events.join(ties, "lock_id")
        .join(F.broadcast(event_types.select("event_type", "category")), "event_type")
        .orderBy(F.desc("event_time"), F.asc("event_id"))
        .limit(n)  # each has a copy at least, so no other event can be among the first n
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.least("_rows", F.lit(n)).cast("int"))))
        .orderBy(F.desc("event_time"), F.asc("event_id"))
        .limit(n)
    )
    newest = checkpointed(newest)  # n rows, used twice below
    probes = F.broadcast(newest.select("event_id", "lock_id", "event_time").distinct()).alias("e")
    at_or_before = (F.col("l.lock_id") == F.col("e.lock_id")) & (F.col("l.update_time") <= F.col("e.event_time"))
    latest = (
        locations.alias("l")
        .join(probes, at_or_before)
        .groupBy("event_id")
        .agg(F.max_by(F.struct("latitude", "longitude"), F.struct("update_time", "id")).alias("at"))
    )
    return (
        newest.join(F.broadcast(latest), "event_id", "left")
        .select(
            "event_id",
            "lock_id",
            "event_type",
            "category",
            "severity",
            "event_time",
            "at.latitude",
            "at.longitude",
        )
        .orderBy(F.desc("event_time"), F.asc("event_id"))
    )
