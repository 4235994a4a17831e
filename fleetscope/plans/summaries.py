"""Per-shipment and per-lock batch tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope import model
from fleetscope.functions.geo import grid
from fleetscope.functions.scoring import event_class, flag, is_compromised, severity_flag
from fleetscope.functions.timecols import date_key, seconds_between, trailing_partitions, ts_lit
from fleetscope.operators.asof import DAY, asof_join, interval_join, interval_totals


def _per_lock(events: DataFrame) -> DataFrame:
    return events.groupBy("lock_id").agg(
        F.count("*").alias("n"), F.sum(severity_flag("critical")).alias("critical")
    )


def _zero(col: str):
    return F.coalesce(col, F.lit(0).cast("bigint")).alias(col)


def daily_shipment_summary(
    shipments: DataFrame,
    events: DataFrame,
    assignments: DataFrame,
    as_of=None,
    point_in_time: bool = False,
) -> DataFrame:
    """Events, critical events and locks per shipment.

    By default each event counts for every assignment its lock ever had; events are counted per lock
    before they meet the assignments. With ``point_in_time`` an event counts only for the
    assignments that held at its time.
    """
    if point_in_time:
        points = events.select("lock_id", "event_time", F.lit(1).alias("n"), severity_flag("critical").alias("critical"))
        totals = interval_totals(
            points,
            assignments,
            "lock_id",
            "event_time",
            "assigned_at",
            "released_at",
            ["n", "critical"],
            ["shipment_pk", "lock_id"],
        )
        locks = assignments.select("shipment_pk", "lock_id").distinct()
        per_shipment = (
            locks.join(totals, ["shipment_pk", "lock_id"], "left")
            .groupBy("shipment_pk")
            .agg(
                F.sum("n").alias("total_events"),
                F.sum("critical").alias("critical_events"),
                F.count("*").alias("locks_count"),
            )
        )
    else:
        pairs = assignments.groupBy("shipment_pk", "lock_id").agg(F.count("*").alias("times"))
        per_shipment = (
            pairs.join(_per_lock(events), "lock_id", "left")
            .groupBy("shipment_pk")
            .agg(
                F.sum(F.col("times") * F.col("n")).alias("total_events"),
                F.sum(F.col("times") * F.col("critical")).alias("critical_events"),
                F.count("*").alias("locks_count"),
            )
        )
    return shipments.join(per_shipment, "shipment_pk", "left").select(
        "shipment_id",
        "status",
        _zero("total_events"),
        _zero("critical_events"),
        _zero("locks_count"),
        "last_update",
        F.to_date(ts_lit(as_of)).alias("summary_date"),
    )


def _per_day(spans: DataFrame, start: str, end) -> DataFrame:
    """Each span once per ``day`` it touches, cut to ``[from, to)`` within that day."""
    days = F.sequence(F.date_trunc("day", start), F.date_trunc("day", "_end"), F.expr("INTERVAL 1 DAY"))
    spans = spans.withColumn("_end", end).filter(F.col(start) < F.col("_end"))
    spans = spans.withColumn("day", F.explode(days)).filter(F.col("day") < F.col("_end"))
    until = F.least(F.col("_end"), F.col("day") + F.expr("INTERVAL 1 DAY"))
    return spans.withColumns({"from": F.greatest(F.col(start), F.col("day")), "to": until}).drop("_end")


def _one_day() -> Column:
    return F.expr("INTERVAL 1 DAY")


def _whole_days(spans: DataFrame) -> DataFrame:
    """Of each span the whole days in it, as one span; none if there are none."""
    low, high = F.date_trunc("day", "from"), F.date_trunc("day", "to")
    low = F.when(F.col("from") == low, low).otherwise(low + _one_day())
    return spans.withColumns({"from": low, "to": high}).filter(F.col("from") < F.col("to"))


def _part_days(spans: DataFrame) -> DataFrame:
    """Of each span what lies before and after its whole days: two pieces at most, each within a day."""
    low, high = F.date_trunc("day", "from"), F.date_trunc("day", "to")
    piece = lambda start, end: F.struct(start.alias("from"), end.alias("to"))
    head = F.when((F.col("from") > low) | (low == high), piece(F.col("from"), F.least("to", low + _one_day())))
    tail = F.when((F.col("to") > high) & (high > low), piece(high, F.col("to")))
    others = [c for c in spans.columns if c not in ("from", "to")]
    return spans.select(*others, F.explode(F.array_compact(F.array(head, tail))).alias("_piece")).select(*others, "_piece.*")


def _locks_per_day(spans: DataFrame) -> DataFrame:
    """date_key, shipment_pk and total_locks: the locks assigned to it at any time of the day.

    Spans count as steps up on their first day and down after their last. Steps of a shipment and lock
    become one step up and down per stretch of days, and these become running totals of the shipment,
    so that no span is listed by day; windows see one row per day at most.
    """
    ends = F.array(
        F.struct(F.date_trunc("day", "from").alias("day"), F.lit(1).alias("step")),
        F.struct((F.date_trunc("day", F.col("to") - F.expr("INTERVAL 1 MICROSECOND")) + _one_day()).alias("day"), F.lit(-1).alias("step")),
    )
    pair, shipment = ["shipment_pk", "lock_id"], ["shipment_pk"]
    steps = spans.select(*pair, F.inline(ends)).groupBy(*pair, "day").agg(F.sum("step").alias("step"))
    upto = F.sum("step").over(Window.partitionBy(*pair).orderBy("day"))
    held = steps.withColumn("held", upto).withColumn("was", F.col("held") - F.col("step"))
    change = flag(F.col("held") > 0) - flag(F.col("was") > 0)
    turns = held.groupBy(*shipment, "day").agg(F.sum(change).alias("step")).filter(F.col("step") != 0)
    lane = Window.partitionBy(*shipment).orderBy("day")
    levels = turns.select(*shipment, "day", F.sum("step").over(lane).alias("total_locks"), F.lead("day").over(lane).alias("until"))
    days = F.sequence("day", F.col("until") - _one_day(), _one_day())
    listed = levels.filter(F.col("total_locks") > 0).select(*shipment, "total_locks", F.explode(days).alias("day"))
    return listed.select(date_key("day").alias("date_key"), *shipment, "total_locks")


def daily_shipment_facts(
    events: DataFrame,
    assignments: DataFrame,
    status_changes: DataFrame,
    shipments: DataFrame,
    shipment_history: DataFrame,
    as_of=None,
) -> DataFrame:
    """The documented summary per date and shipment.

    Events, status changes and compromised locks belong to the shipment their lock was assigned to
    at the time; total_locks are the locks assigned at any time of the day; open assignments last
    until ``as_of``. Facts are counted per lock and day, or read off running totals, before they
    meet assignments; no pair of event and assignment is formed, and no assignment is listed day by day. The minutes in transit come from
    the shipment's own history.
    """
    part = ["date_key", "shipment_pk"]
    counted = ["total_events", "critical_events", "warning_events", "status_changes", "compromised"]
    one = F.lit(1)
    points = events.select(
        "lock_id",
        F.col("event_time").alias("at"),
        one.alias("total_events"),
        severity_flag("critical").alias("critical_events"),
        flag(event_class() == "WARNING").alias("warning_events"),
    ).unionByName(
        status_changes.select(
            "lock_id",
            F.col("change_time").alias("at"),
            one.alias("status_changes"),
            flag(is_compromised()).alias("compromised"),
        ),
        allowMissingColumns=True,
    )
    until = F.coalesce("released_at", ts_lit(as_of))
    spans = assignments.select("shipment_pk", "lock_id", F.col("assigned_at").alias("from"), until.alias("to"))
    spans = spans.filter(F.col("from") < F.col("to"))
    # whole days take the lock's totals of these days; only first and last days need the running totals
    keys = [*part, "lock_id"]
    daily = points.groupBy("lock_id", F.date_trunc("day", "at").alias("day")).agg(*[F.sum(c).alias(c) for c in counted])
    whole = interval_join(daily, _whole_days(spans), "lock_id", "day", "from", "to", ["shipment_pk"], "inner", unit=DAY)
    of_whole = whole.withColumn("date_key", date_key("day")).select(*keys, *counted)
    edges = _part_days(spans).withColumn("day", F.date_trunc("day", "from"))
    # pieces of days without a point of the lock add nothing; their shipments are listed by their locks below
    edges = edges.join(daily.select("lock_id", "day"), ["lock_id", "day"], "left_semi").withColumn("date_key", date_key("day"))
    of_parts = interval_totals(points, edges, "lock_id", "at", "from", "to", counted, keys)
    by_lock = of_whole.unionByName(of_parts).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counted])
    by_day = by_lock.groupBy(*part).agg(
        *[F.sum(c).alias(c) for c in counted[:4]],
        F.sum(flag(F.col("compromised") > 0)).alias("compromised_locks"),
    )
    by_day = by_day.unionByName(_locks_per_day(spans), allowMissingColumns=True)
    moving = shipment_history.filter(F.col("status") == "in_transit")
    by_transit = (
        _per_day(moving, "effective_from", F.least(F.col("effective_to"), ts_lit(as_of)))
        .groupBy(date_key("day").alias("date_key"), "shipment_id")
        .agg(F.floor(F.sum(seconds_between("to", "from")) / 60).alias("time_in_transit_min"))
        .join(shipments.select("shipment_pk", "shipment_id"), "shipment_id")
        .drop("shipment_id")
    )
    measures = by_day.unionByName(by_transit, allowMissingColumns=True)
    names = [c for c in measures.columns if c not in part]
    return measures.groupBy(*part).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])


def lock_utilization(assignments: DataFrame, as_of=None) -> DataFrame:
    """Assignment count, mean and total hours, and share of the observed time, per lock.

    Whole seconds are summed and divided at the end, so the result does not depend on the order in
    which partial sums meet.
    """
    end = F.coalesce("released_at", ts_lit(as_of))
    per_lock = (
        assignments.withColumns({"_end": end, "_seconds": seconds_between(end, "assigned_at")})
        .groupBy("lock_id")
        .agg(
            F.count("*").alias("total_assignments"),
            F.sum("_seconds").alias("_assigned"),
            seconds_between(F.max("_end"), F.min("assigned_at")).alias("_observed"),
        )
    )
    share = F.when(F.col("_observed") > 0, F.least(F.lit(1.0), F.col("_assigned") / F.col("_observed")))
    return per_lock.select(
        "lock_id",
        "total_assignments",
        F.round(F.col("_assigned") / (F.col("total_assignments") * 3600), 2).alias("avg_assignment_duration_hours"),
        F.round(F.coalesce(share, F.lit(0.0)), 4).alias("utilization_rate"),
        F.round(F.col("_assigned") / 3600, 2).alias("total_assigned_hours"),
        ts_lit(as_of).alias("calculated_at"),
    )


def utilization_histogram(utilization: DataFrame, buckets: int = 10) -> DataFrame:
    """Number of locks per utilization bucket; a rate of exactly 1 belongs to the last one."""
    bucket = F.least(F.floor(F.col("utilization_rate") * buckets) + 1, F.lit(buckets).cast("bigint"))
    return utilization.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("locks"))


def critical_events_per_shipment(shipments: DataFrame, assignments: DataFrame, events: DataFrame) -> DataFrame:
    """Per assigned shipment: distinct locks, and events counted once per assignment of their lock."""
    pairs = assignments.groupBy("shipment_pk", "lock_id").agg(F.count("*").alias("times"))
    per_shipment = (
        pairs.join(_per_lock(events), "lock_id", "left")
        .groupBy("shipment_pk")
        .agg(
            F.count("*").alias("total_locks"),
            F.coalesce(F.sum(F.col("times") * F.col("n")), F.lit(0)).alias("total_events"),
            F.coalesce(F.sum(F.col("times") * F.col("critical")), F.lit(0)).alias("critical_events"),
        )
    )
    return (
        shipments.select("shipment_pk", "shipment_id")
        .join(per_shipment, "shipment_pk")
        .drop("shipment_pk")
        .orderBy(F.desc("critical_events"), "shipment_id")
    )


def compromised_recent(locks: DataFrame, events: DataFrame, as_of) -> DataFrame:
    """Compromised locks with the number and types of their events in the last hour."""
    recent = (
        trailing_partitions(events, "event_time", as_of, "1 HOUR", strict=True)
        .groupBy("lock_id")
        .agg(F.count("*").alias("n"), F.array_sort(F.collect_set("event_type")).alias("types"))
    )
    return (
        locks.filter(is_compromised())
        .select(F.col("id").alias("lock_id"), "status")
        .join(recent, "lock_id", "left")
        .select(
            "lock_id",
            "status",
            F.coalesce("n", F.lit(0)).alias("events_last_hour"),
            F.coalesce("types", F.array().cast("array<string>")).alias("event_types"),
        )
        .orderBy(F.desc("events_last_hour"), "lock_id")
    )


def event_summary(events: DataFrame) -> DataFrame:
    return events.groupBy("lock_id", "event_type", "severity").agg(
        F.count("*").alias("event_count"),
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
    )


def locks_by_status(locks: DataFrame) -> DataFrame:
    return locks.groupBy("status").agg(F.count("*").alias("locks"))


def status_totals(locks: DataFrame) -> DataFrame:
    """Fleet totals per status in one row, with the share of locks that are not compromised."""
    count_of = lambda s: F.sum(flag(F.col("status") == s)).alias(s)
    return locks.agg(
        F.count("*").alias("locks"),
        *[count_of(s) for s in model.LOCK_STATUSES],
        F.round(F.avg(F.when(is_compromised(), 0.0).otherwise(1.0)), 4).alias("ok_share"),
    )


def locks_changed_recently(status_changes: DataFrame, as_of, interval: str = "1 HOUR") -> DataFrame:
    recent = trailing_partitions(status_changes, "change_time", as_of, interval)
    return recent.groupBy("lock_id").agg(
        F.count("*").alias("changes"),
        F.max_by("status", F.struct("change_time", "id")).alias("status"),
        F.max("change_time").alias("last_change"),
    )


def top_locks(events: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` locks with most events; per lock and type first, so types are never a distinct set."""
    return (
        events.groupBy("lock_id", "event_type")
        .agg(F.count("*").alias("n"), F.max("event_time").alias("last"))
        .groupBy("lock_id")
        .agg(
            F.sum("n").alias("total_events"),
            F.count("*").alias("distinct_types"),
            F.max("last").alias("last_event"),
        )
        .orderBy(F.desc("total_events"), F.asc("lock_id"))
        .limit(k)
    )


def top_incident_locks(events: DataFrame, k: int = 10) -> DataFrame:
    return (
        events.filter(F.col("severity").isin("high", "critical"))
        .groupBy("lock_id")
        .agg(F.count("*").alias("incidents"))
        .orderBy(F.desc("incidents"), F.asc("lock_id"))
        .limit(k)
    )


def lock_positions(locks: DataFrame, locations: DataFrame) -> DataFrame:
    where = locations.select(F.col("lock_id").alias("id"), "latitude", "longitude")
    return locks.join(where, "id").select("id", "status", "latitude", "longitude", "last_update")


def lock_mtbf(events: DataFrame) -> DataFrame:
    """Mean seconds between tamper events per lock: time from first to last over the gaps between."""
    tampers = events.filter(F.col("event_type") == "tamper_detected")
    per_lock = tampers.groupBy("lock_id").agg(
        F.count("*").alias("failures"),
        F.min("event_time").alias("_first"),
        F.max("event_time").alias("_last"),
    )
    span = seconds_between("_last", "_first")
    mtbf = F.when(F.col("failures") > 1, span / (F.col("failures") - 1))
    return per_lock.select("lock_id", "failures", F.round(mtbf, 2).alias("mtbf_seconds"))


def event_positions(events: DataFrame, locations: DataFrame) -> DataFrame:
    """Each event with the latest position of its lock at or before it."""
    return asof_join(
        events, locations, "lock_id", "event_time", "update_time", ["latitude", "longitude"], "id"
    )


def geo_heatmap(events: DataFrame, locations: DataFrame, cell: float = 0.1) -> DataFrame:
    """Critical events per grid cell of the position their lock had."""
    placed = event_positions(events.filter(F.col("severity") == "critical"), locations)
    return (
        placed.filter(F.col("latitude").isNotNull())
        .groupBy(grid("latitude", cell).alias("lat_cell"), grid("longitude", cell).alias("lon_cell"))
        .agg(F.count("*").alias("critical_events"))
    )


def trajectory(moves: DataFrame, lock_id: str, start, end) -> DataFrame:
    """The moves of one lock in ``[start, end)`` in order."""
    return (
        moves.filter(F.col("lock_id") == lock_id)
        .filter((F.col("update_time") >= ts_lit(start)) & (F.col("update_time") < ts_lit(end)))
        .orderBy("update_time")
    )
