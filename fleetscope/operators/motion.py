"""Movement, routes, battery and incident operators on device readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope import model
from fleetscope.functions.geo import haversine_m
from fleetscope.functions.scoring import severity_flag
from fleetscope.functions.timecols import seconds_between, ts_lit
from fleetscope.operators.ordered import over_history, rolling_count, sessions

# ---- fixed values: battery thresholds (percent) and their severities -----------------------------
BATTERY_LEVELS = [(20, "medium"), (10, "high"), (5, "critical")]


def distance_delta(
    locations: DataFrame, order: list[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Metres and km/h from the previous position of each lock; null for its first position.

    ``keep`` names further input columns to pass through.
    """
    order = order or ["update_time", "id"]
    ts = order[0]
    pairs = over_history(
        locations,
        "lock_id",
        order,
        lambda w: {"_was": F.lag(F.struct(ts, "latitude", "longitude")).over(w)},
        back=1,
    )
    hours = (F.unix_micros(ts) - F.unix_micros(f"_was.{ts}")) / F.lit(3.6e9)
    metres = haversine_m("_was.latitude", "_was.longitude", "latitude", "longitude")
    return pairs.withColumn("distance_delta_m", metres).select(
        "lock_id",
        "latitude",
        "longitude",
        ts,
        "distance_delta_m",
        F.when(hours > 0, F.col("distance_delta_m") / 1000 / hours).alias("speed_kmh"),
        *keep,
    )


def speeding(moves: DataFrame, limit_kmh: float) -> DataFrame:
    return moves.filter(F.col("speed_kmh") > limit_kmh)


def geofence_breaches(positions: DataFrame, lat: float, lon: float, radius_m: float) -> DataFrame:
    """Positions outside a circle around (lat, lon)."""
    metres = haversine_m("latitude", "longitude", F.lit(lat), F.lit(lon))
    return positions.withColumn("distance_m", metres).filter(F.col("distance_m") > radius_m)


def route_segments(points: DataFrame) -> DataFrame:
    """The legs of each route with the share of the route at which they start and end.

    The first leg is open to the left and the last one to the right, so every progress value falls
    into exactly one leg. A route is a short waypoint list, so the windows here are tiny.
    """
    w = Window.partitionBy("route").orderBy("seq")
    whole = Window.partitionBy("route")
    d_lat, d_lon = F.col("to_lat") - F.col("from_lat"), F.col("to_lon") - F.col("from_lon")
    legs = (
        points.select(
            "route",
            "seq",
            F.col("latitude").alias("from_lat"),
            F.col("longitude").alias("from_lon"),
            F.lead("latitude").over(w).alias("to_lat"),
            F.lead("longitude").over(w).alias("to_lon"),
        )
        .filter(F.col("to_lat").isNotNull())
        .withColumn("length", F.sqrt(d_lat * d_lat + d_lon * d_lon))
        .withColumns({"upto": F.sum("length").over(w), "total": F.sum("length").over(whole)})
    )
    return legs.withColumns(
        {
            "after": F.when(F.col("seq") == F.min("seq").over(whole), float("-inf")).otherwise(
                F.lag("upto").over(w)
            ),
            "until": F.when(F.col("seq") == F.max("seq").over(whole), float("inf")).otherwise(F.col("upto")),
        }
    )


def route_position(progress: DataFrame, legs: DataFrame) -> DataFrame:
    """``expected_lat`` and ``expected_lon`` at ``progress`` (0 to 1, clamped) along each row's route.

    ``legs`` comes from ``route_segments``. Each row meets the one leg of its route that holds its
    progress; Spark broadcasts the legs while they are few.
    """
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("progress")))
    at = share * F.col("total")
    rows = progress.join(legs, (progress["route"] == legs["route"]) & (at > F.col("after")) & (at <= F.col("until")))
    into = F.when(F.col("length") > 0, (at - (F.col("upto") - F.col("length"))) / F.col("length"))
    into = F.when(F.col("progress") >= 1, 1.0).when(F.col("progress") <= 0, 0.0).otherwise(into)

    def between(axis: str):
        start, end = F.col(f"from_{axis}"), F.col(f"to_{axis}")
        return F.when(into == 1.0, end).otherwise(start + F.coalesce(into, F.lit(0.0)) * (end - start))

    # generated rather than projected: otherwise a later filter on the position, or on a distance to
    # it, is pushed into the join condition and the long expression runs once per leg and row
    point = F.inline(F.array(F.struct(between("lat"), between("lon")))).alias("expected_lat", "expected_lon")
    return rows.select(*[progress[c] for c in progress.columns], point)


def route_deviation(positions: DataFrame, threshold_m: float = 500.0) -> DataFrame:
    """Positions farther than the threshold from where they were expected, as deviation events."""
    metres = haversine_m("latitude", "longitude", "expected_lat", "expected_lon")
    return (
        positions.withColumn("distance_m", metres)
        .filter(F.col("distance_m") > threshold_m)
        .select(
            "lock_id",
            "update_time",
            "distance_m",
            F.lit("location_deviation").alias("event_type"),
            F.lit("high").alias("severity"),
        )
    )


def battery_crossings(readings: DataFrame, ts: str = "reading_time", tie: str = "id") -> DataFrame:
    """The first reading of each lock at or below each battery threshold."""
    reading = F.struct(ts, tie, "battery_pct")
    firsts = [
        F.min(F.when(F.col("battery_pct") <= level, reading)).alias(f"at_{level}")
        for level, _ in BATTERY_LEVELS
    ]
    levels = F.array(
        *[
            F.struct(F.lit(level).alias("threshold"), F.lit(severity).alias("severity"), F.col(f"at_{level}").alias("hit"))
            for level, severity in BATTERY_LEVELS
        ]
    )
    return (
        readings.groupBy("lock_id")
        .agg(*firsts)
        .select("lock_id", F.inline(levels))
        .filter(F.col("hit").isNotNull())
        .select("lock_id", "threshold", F.col(f"hit.{ts}").alias(ts), "hit.battery_pct", "severity")
    )


def incident_bursts(events: DataFrame, n: int = 15, seconds: int = 30) -> DataFrame:
    """Tamper and unlock events of high severity that end a run of ``n`` or more in ``seconds``."""
    suspicious = events.filter(
        F.col("event_type").isin("tamper_detected", "unlock_attempt")
        & F.col("severity").isin("high", "critical")
    )
    timed = suspicious.select("lock_id", "id", "event_time", F.unix_timestamp("event_time").alias("_sec"))
    counted = rolling_count(timed, "lock_id", "_sec", seconds, "events_in_window")
    return counted.filter(F.col("events_in_window") >= n).drop("_sec")


def incidents(events: DataFrame) -> DataFrame:
    return events.filter(F.col("severity").isin("high", "critical"))


def incident_measures() -> dict[str, Column]:
    return {"incidents": F.count("*"), "critical_incidents": F.sum(severity_flag("critical"))}


def incident_sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Stretches of high and critical events of a lock with less than ``gap`` between them."""
    return sessions(incidents(events), "lock_id", ["event_time", "id"], gap, incident_measures())


def status_durations(
    changes: DataFrame, order: list[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Seconds each lock spent in its status before each change; null for its first one."""
    order = order or ["change_time", "id"]
    ts = order[0]
    pairs = over_history(
        changes, "lock_id", order, lambda w: {"_was": F.lag(F.struct(ts, "status")).over(w)}, back=1
    )
    return pairs.select(
        "lock_id",
        F.col("_was.status").alias("previous_status"),
        F.col("status").alias("new_status"),
        ts,
        seconds_between(ts, f"_was.{ts}").alias("duration_seconds"),
        *keep,
    )


def anomalous_transitions(durations: DataFrame, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Status changes that match one of the given (from, to) pairs."""
    pairs = pairs or model.ANOMALOUS_TRANSITIONS
    hit = F.lit(False)
    for before, after in pairs:
        hit = hit | ((F.col("previous_status") == before) & (F.col("new_status") == after))
    return durations.filter(hit)


def time_in_status(changes: DataFrame, as_of, order: list[str] | None = None) -> DataFrame:
    """Total seconds per lock and status; the last status lasts until ``as_of``."""
    order = order or ["change_time", "id"]
    ts = order[0]
    spans = over_history(changes, "lock_id", order, lambda w: {"_until": F.lead(ts).over(w)}, ahead=1)
    seconds = seconds_between(F.coalesce("_until", ts_lit(as_of)), ts)
    return spans.groupBy("lock_id", "status").agg(
        F.sum(seconds).alias("seconds_in_status"), F.count("*").alias("periods")
    )
