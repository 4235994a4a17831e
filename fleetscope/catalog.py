"""Every registered query over the test views: name -> function of the views."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.functions import geo, scoring
from fleetscope.functions.routes import ROUTE_POINT_SCHEMA, ROUTE_POINTS, ROUTES
from fleetscope.functions.timecols import from_millis, with_date_key
from fleetscope.operators import changelog, dims, fences, motion, ordered, quality
from fleetscope.operators.asof import interval_join
from fleetscope.plans import alerts, health, sequences, summaries, trends, upkeep
from fleetscope.session import configure, shared_dir, small_table
from fleetscope.sources import tables
from fleetscope.sources.testviews import AS_OF, TestViews
from fleetscope.sources.versions import VersionedTable
from fleetscope.streaming import conditions, replay

Query = Callable[[TestViews], DataFrame]
QUERIES: dict[str, Query] = {}

DEPOT = (-33.5, -59.5)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _days_as_text(df: DataFrame) -> DataFrame:
    """Dates as text, so results compare the same whatever client reads them."""
    days = [f.name for f in df.schema if f.dataType.typeName() == "date"]
    return df.withColumns({c: F.col(c).cast("string") for c in days}) if days else df


def _batches(df: DataFrame, key: str, n: int) -> list[DataFrame]:
    """All rows, dealt into ``n`` change batches whatever their times."""
    return [df.filter(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)]


def _rounded(df: DataFrame, *cols: str, digits: int = 3) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# ---- sources and profiles ------------------------------------------------------------------------


@query
def table_counts(v):
    return tables.table_counts(v.all())


@query
def table_listing(v):
    """Registered views with their size: catalog listing joined to the table profile."""
    views = v.all()
    tables.register_views(views)
    counts = tables.table_counts(views).select("table_name", "row_count")
    return tables.list_tables(v.spark).join(counts, "table_name")


@query
def event_type_stats_sql(v):
    """The push-down query text, run by Spark over registered views."""
    tables.register_views({"security_events": v.security_events()})
    return tables.run_query(
        v.spark,
        tables.Lake(v.sf_dir),
        """SELECT event_type, severity, COUNT(*) AS total,
                  MIN(event_time) AS first_event, MAX(event_time) AS last_event
           FROM security_events GROUP BY event_type, severity""",
    )


@query
def with_date_key_counts(v):
    dated = with_date_key(v.security_events(), "event_time")
    return dated.groupBy("date_key").agg(F.count("*").alias("event_count"))


@query
def decoded_event_times(v):
    """Wire milliseconds back to timestamps; sub-millisecond digits are lost on the wire."""
    wire = v.security_events().select("id", "lock_id", F.unix_millis("event_time").alias("timestamp"))
    return wire.select("id", "lock_id", from_millis("timestamp").alias("event_time"))


@query
def insert_ignore(v):
    """Every event arrives twice and the older ones are stored already: what still has to be added."""
    events = v.security_events()
    stored = events.filter(F.col("event_time") < F.lit("2024-01-16").cast("timestamp"))
    return quality.insert_ignore(events.unionAll(events), stored, "id", order=["event_time"]).select("id", "lock_id")


@query
def validate_locations(v):
    """Positions stretched so that some leave the valid range; counts per verdict."""
    stretched = v.fact_location_updates().select(
        "id", "lock_id", (F.col("latitude") * 2.7).alias("latitude"), (F.col("longitude") * 3.03).alias("longitude")
    )
    rules = [quality.between("latitude", -90, 90), quality.between("longitude", -180, 180)]
    valid, quarantine = quality.validate(stretched, rules)
    both = valid.select(F.lit("valid").alias("reason")).unionByName(quarantine.select("reason"))
    return both.groupBy("reason").agg(F.count("*").alias("rows"))


@query
def validate_events(v):
    """Events with one type and one severity outside the domains; quarantined rows with the reason."""
    events = v.security_events().withColumns(
        {
            "event_type": F.when(F.col("event_type") == "battery_low", "battery_gone").otherwise(F.col("event_type")),
            "severity": F.when(F.col("severity") == "critical", "fatal").otherwise(F.col("severity")),
        }
    )
    events = events.withColumnRenamed("id", "event_id")
    _, quarantine = quality.validate(events, quality.record_rules("security_event"))
    return quarantine.select("event_id", "reason")


@query
def fk_valid_events(v):
    known = v.locks().filter(F.col("status") != "offline")
    kept, _ = quality.enforce_fk(v.security_events(), known, "lock_id", "id")
    return kept.groupBy("lock_id").agg(F.count("*").alias("event_count"))


@query
def fk_orphans(v):
    known = v.locks().filter(F.col("status") != "offline")
    _, orphans = quality.enforce_fk(v.security_events(), known, "lock_id", "id")
    return orphans.select("id", "lock_id", "reason")


@query
def fk_report(v):
    facts, dates = v.fact_security_events(), dims.dim_date(v.spark, "2024-01-05", "2024-12-31")
    changes = with_date_key(v.fact_lock_status_changes(), "change_time")
    moves = with_date_key(v.fact_location_updates(), "update_time")
    return quality.fk_report(
        [
            ("events_to_date", facts, "date_key", dates, "date_key"),
            ("events_to_type", facts, "event_type", dims.dim_event_type(v.spark), "event_type"),
            ("status_to_date", changes, "date_key", dates, "date_key"),
            ("locations_to_date", moves, "date_key", dates, "date_key"),
            ("locations_to_lock", moves, "lock_id", v.locks(), "id"),
        ]
    )


# ---- lookups, filters, simple aggregates ---------------------------------------------------------


@query
def lock_lookup(v):
    """One lock with its position; no row for an unknown id."""
    return summaries.lock_positions(v.locks().filter(F.col("id") == "7"), v.locations())


@query
def shipment_lookup(v):
    return v.shipments().filter(F.col("shipment_id") == "SHIP0000000003")


@query
def events_by_severity(v):
    return trends.events_by_severity(v.security_events(), "high")


@query
def events_all(v):
    return trends.events_by_severity(v.security_events())


@query
def active_assignments(v):
    active = dims.with_active_flag(v.lock_assignments()).filter("is_active")
    return active.select("id", "lock_id", "shipment_pk", "assigned_at")


@query
def assigned_locks(v):
    """Locks with at least one active assignment, each once."""
    active = v.lock_assignments().filter(F.col("released_at").isNull())
    holders = active.select(F.col("lock_id").alias("id"))
    return v.locks().join(holders, "id", "left_semi").select("id", "status")


@query
def compromised_locks(v):
    return v.locks().filter(scoring.is_compromised()).select("id", "status")


@query
def events_of_compromised_locks(v):
    bad, _ = quality.enforce_fk(v.security_events(), v.locks().filter(scoring.is_compromised()), "lock_id", "id")
    return bad.select("id", "lock_id", "event_type", "event_time")


@query
def shipment_codes(v):
    held = v.lock_assignments().select(scoring.shipment_code("shipment_pk").alias("shipment_id"))
    return held.groupBy("shipment_id").agg(F.count("*").alias("assignments"))


@query
def event_class(v):
    return trends.events_by_class(v.security_events())


@query
def dim_event_type(v):
    return trends.events_by_category(v.security_events(), dims.dim_event_type(v.spark))


@query
def dim_date(v):
    return _days_as_text(trends.events_by_calendar(v.security_events(), dims.dim_date(v.spark)))


@query
def events_by_type_severity(v):
    return trends.event_totals(v.security_events())


@query
def locks_by_status(v):
    return summaries.locks_by_status(v.locks())


@query
def status_totals(v):
    return summaries.status_totals(v.locks())


@query
def locks_changed_recently(v):
    return summaries.locks_changed_recently(v.fact_lock_status_changes(), AS_OF, "6 HOURS")


@query
def top_locks(v):
    return summaries.top_locks(v.security_events())


@query
def top_incident_locks(v):
    return summaries.top_incident_locks(v.security_events())


@query
def lock_positions(v):
    return summaries.lock_positions(v.locks(), v.locations())


@query
def event_type_stats(v):
    return trends.event_type_stats(v.security_events())


@query
def event_summary(v):
    return summaries.event_summary(v.security_events())


# ---- trends --------------------------------------------------------------------------------------


def _trend(v):
    return trends.hourly_event_trend(v.security_events(), dims.dim_date(v.spark), dims.dim_event_type(v.spark))


@query
def hourly_event_trend(v):
    return _days_as_text(_trend(v))


@query
def recent_hourly_trend(v):
    return trends.recent_hourly_trend(v.security_events(), AS_OF)


@query
def trend_24h(v):
    return trends.trend_24h(_trend(v), AS_OF)


@query
def daily_severity_30d(v):
    return _days_as_text(trends.daily_severity_30d(v.security_events(), dims.dim_date(v.spark), AS_OF))


@query
def top_types_7d(v):
    return trends.top_types_7d(v.security_events(), dims.dim_event_type(v.spark), AS_OF)


@query
def heatmap(v):
    return trends.heatmap(v.security_events())


@query
def critical_spikes(v):
    return trends.critical_spikes(v.security_events())


@query
def event_severity_rollup(v):
    return trends.event_severity_rollup(v.security_events(), AS_OF)


@query
def agg_hourly_event_counts(v):
    return trends.agg_hourly_event_counts(v.security_events())


@query
def events_per_minute(v):
    return trends.events_per_minute(v.security_events(), AS_OF)


@query
def lateness(v):
    return trends.lateness(v.arrivals())


# ---- sequences -----------------------------------------------------------------------------------


@query
def latest_event_per_lock(v):
    return sequences.latest_event_per_lock(v.security_events())


@query
def time_between_events(v):
    return sequences.time_between_events(v.security_events())


@query
def running_totals(v):
    return sequences.running_totals(v.security_events())


@query
def rank_locks(v):
    return sequences.rank_locks(v.security_events())


@query
def event_sequences(v):
    return sequences.event_sequences(v.security_events())


@query
def attack_pattern(v):
    return sequences.attack_pattern(v.security_events())


@query
def sliding_3(v):
    return sequences.sliding(v.security_events())


@query
def event_window_sql(v):
    return sequences.event_windows(v.security_events())


@query
def events_last_hour_range(v):
    return sequences.events_last_hour(v.security_events())


@query
def events_last_day_range(v):
    return sequences.events_last_hour(v.security_events(), seconds=86400).withColumnRenamed(
        "events_last_hour", "events_last_day"
    )


# ---- health and summaries ------------------------------------------------------------------------


def _health(v, events=None, **mode):
    events = v.fact_security_events() if events is None else events
    return health.shipment_health(
        v.dim_shipment(), v.fact_lock_status_changes(), events, v.fact_location_updates(), **mode
    )


@query
def shipment_health(v):
    return _health(v)


@query
def mv_shipment_health(v):
    """The health view kept up from four batches of new facts, instead of built from all of them."""
    view = upkeep.ShipmentHealth(VersionedTable(shared_dir(v.spark, "health-view")), buckets=8)
    facts = (v.fact_lock_status_changes(), v.security_events(), v.fact_location_updates())
    for n, parts in enumerate(zip(*(_batches(f, "id", 4) for f in facts))):
        view.apply(*parts, n)
    return view.read(v.dim_shipment())


@query
def mv_hourly_event_trend(v):
    """The hourly trend kept up from four batches of new events."""
    view = upkeep.HourlyCounts(VersionedTable(shared_dir(v.spark, "hourly-view")))
    for n, part in enumerate(_batches(v.security_events(), "id", 4)):
        view.apply(part, n)
    return _days_as_text(trends.trend_view(view.read(v.spark), dims.dim_date(v.spark), dims.dim_event_type(v.spark)))


@query
def shipment_health_dedup(v):
    return _health(v, fanout=False)


@query
def shipment_health_dashboard(v):
    return health.shipment_health_dashboard(_health(v))


@query
def shipment_health_labels(v):
    return health.shipment_health_dashboard(_health(v, fanout=False))


@query
def shipment_event_detail(v):
    return health.shipment_event_detail(
        v.fact_security_events(),
        dims.dim_event_type(v.spark),
        v.fact_lock_status_changes(),
        v.fact_location_updates(),
        "SHIP0000000004",
    )


@query
def api_shipment_health(v):
    return health.api_shipment_health(v.shipments(), v.lock_assignments(), v.locks(), v.security_events(), AS_OF)


@query
def mv_shipment_health_doc(v):
    return health.mv_shipment_health(v.lock_assignments(), v.locks(), v.security_events(), AS_OF)


@query
def daily_shipment_summary(v):
    return _days_as_text(
        summaries.daily_shipment_summary(v.shipments(), v.security_events(), v.lock_assignments(), AS_OF)
    )


@query
def daily_shipment_summary_pit(v):
    return _days_as_text(
        summaries.daily_shipment_summary(
            v.shipments(), v.security_events(), v.lock_assignments(), AS_OF, point_in_time=True
        )
    )


@query
def daily_shipment_facts(v):
    history = dims.scd2(v.shipment_log(), "shipment_id", ["status"], "change_time", "seq")
    return summaries.daily_shipment_facts(
        v.security_events(), v.lock_assignments(), v.fact_lock_status_changes(), v.shipments(), history, AS_OF
    )


@query
def lock_utilization(v):
    return summaries.lock_utilization(v.lock_assignments(), AS_OF)


@query
def utilization_histogram(v):
    return summaries.utilization_histogram(summaries.lock_utilization(v.lock_assignments(), AS_OF))


@query
def critical_events_per_shipment(v):
    return summaries.critical_events_per_shipment(v.shipments(), v.lock_assignments(), v.security_events())


@query
def compromised_recent(v):
    found = summaries.compromised_recent(v.locks(), v.security_events(), AS_OF)
    return found.withColumn("event_types", F.concat_ws(",", "event_types"))


@query
def lock_mtbf(v):
    return summaries.lock_mtbf(v.security_events())


# ---- joins over time -----------------------------------------------------------------------------


@query
def asof_location(v):
    placed = summaries.event_positions(v.security_events(), v.fact_location_updates())
    return placed.select("id", "lock_id", "event_time", "latitude", "longitude")


@query
def event_shipment_pit(v):
    held = interval_join(
        v.security_events(),
        v.lock_assignments(),
        "lock_id",
        "event_time",
        "assigned_at",
        "released_at",
        ["shipment_pk"],
    )
    return held.select("id", "lock_id", "event_time", "shipment_pk")


@query
def geo_heatmap(v):
    return summaries.geo_heatmap(v.security_events(), v.fact_location_updates())


# ---- change logs and history ---------------------------------------------------------------------

LOG_ORDER = ["change_time", "seq"]


@query
def current_locks(v):
    return changelog.current_locks(v.lock_status_log(), LOG_ORDER)


@query
def current_locks_by_arrival(v):
    """The same fold in arrival order, as a consumer reading one message after the other sees it."""
    return changelog.current_locks(v.lock_status_log(), ["seq"])


@query
def current_locations(v):
    return changelog.current_locations(v.lock_status_log(), v.location_log(), LOG_ORDER)


@query
def current_shipments(v):
    return changelog.current_shipments(v.shipment_log(), LOG_ORDER)


@query
def security_events_from_log(v):
    """Events sent twice, for locks some of which are unknown: first copy of each known one."""
    log = v.security_events()
    known = v.locks().filter(F.col("status") != "inactive")
    kept, _ = quality.enforce_fk(log.unionAll(log), known, "lock_id", "id")
    empty = log.filter(F.lit(False))
    return quality.insert_ignore(kept, empty, "id", order=["event_time"])


@query
def previous_status(v):
    log = v.fact_lock_status_changes().withColumn("previous_status", F.lit(None).cast("string"))
    filled = changelog.with_previous_status(log, ["change_time", "id"])
    return filled.select("id", "lock_id", "status", "previous_status", "change_time")


def _assignments(v):
    return changelog.assignments_from_log(v.lock_status_log(), v.shipments(), LOG_ORDER)


@query
def assignments_from_log(v):
    return _assignments(v)


@query
def dim_lock_assignment(v):
    held = dims.with_active_flag(_assignments(v))
    return held.groupBy("is_active").agg(F.count("*").alias("assignments"), F.countDistinct("lock_id").alias("locks"))


@query
def scd2_lock(v):
    return dims.scd2(v.fact_lock_status_changes(), "lock_id", ["status"], "change_time", "id")


@query
def scd2_shipment(v):
    return dims.scd2(v.shipment_log(), "shipment_id", ["status"], "change_time", "seq")


@query
def scd2_incremental(v):
    """The lock history from changes that arrive in three batches, in any order."""
    schema = "lock_id string, status string, change_time timestamp, id bigint"
    root = shared_dir(v.spark, "lock-history")
    history = upkeep.History(VersionedTable(root), "lock_id", ("status",), "change_time", "id", schema)
    for n, part in enumerate(_batches(v.fact_lock_status_changes(), "id", 3)):
        history.apply(part, n)
    return history.read(v.spark)


@query
def merge_dimension_parts(v):
    """The lock dimension, stored by buckets and merged with the latest changes of each of three groups of locks."""
    dimension = upkeep.Dimension(VersionedTable(shared_dir(v.spark, "lock-dimension")), "id", "id string, status string")
    dimension.merge(v.locks().select("id", "status"))
    staged = ordered.latest_per_key(v.fact_lock_status_changes(), "lock_id", ["change_time", "id"], ["status"])
    for part in _batches(staged.withColumnRenamed("lock_id", "id"), "id", 3):
        dimension.merge(part)
    return dimension.read(v.spark)


@query
def merge_dimension(v):
    """Lock dimension updated from the latest status changes; locks without a change keep theirs."""
    staged = ordered.latest_per_key(v.fact_lock_status_changes(), "lock_id", ["change_time", "id"], ["status"])
    return dims.merge_dimension(v.locks().select("id", "status"), staged.withColumnRenamed("lock_id", "id"), "id")


# ---- movement and status over time ---------------------------------------------------------------


@query
def status_durations(v):
    return motion.status_durations(v.fact_lock_status_changes())


@query
def time_in_status(v):
    return motion.time_in_status(v.fact_lock_status_changes(), AS_OF)


@query
def anomalous_transitions(v):
    return motion.anomalous_transitions(motion.status_durations(v.fact_lock_status_changes()))


@query
def haversine(v):
    metres = geo.haversine_m("latitude", "longitude", F.lit(DEPOT[0]), F.lit(DEPOT[1]))
    return v.fact_location_updates().select("id", F.round(metres, 3).alias("distance_m"))


@query
def distance_delta(v):
    return _rounded(motion.distance_delta(v.fact_location_updates()), "distance_delta_m", "speed_kmh")


@query
def speeding(v):
    fast = motion.speeding(motion.distance_delta(v.fact_location_updates()), 20.0)
    return _rounded(fast, "distance_delta_m", "speed_kmh")


@query
def geofence_breaches(v):
    out = motion.geofence_breaches(v.fact_location_updates(), *DEPOT, radius_m=50_000)
    return _rounded(out.select("id", "lock_id", "distance_m"), "distance_m")


@query
def trajectory(v):
    moves = motion.distance_delta(v.fact_location_updates().filter(F.col("lock_id") == "3"))
    path = summaries.trajectory(moves, "3", "2024-01-10", "2024-01-20")
    return _rounded(path, "distance_delta_m", "speed_kmh")


def _expected(v):
    points = small_table(v.spark, ROUTE_POINTS, ROUTE_POINT_SCHEMA)
    return motion.route_position(v.route_progress(list(ROUTES)), motion.route_segments(points))


@query
def route_position(v):
    placed = _expected(v).select("id", "route", "progress", "expected_lat", "expected_lon")
    return _rounded(placed, "expected_lat", "expected_lon", digits=6)


@query
def route_deviation(v):
    return _rounded(motion.route_deviation(_expected(v)), "distance_m")


@query
def battery_crossings(v):
    return motion.battery_crossings(v.battery_readings())


@query
def incident_bursts(v):
    """Bursts over a day: the test events are too sparse for bursts within seconds."""
    return motion.incident_bursts(v.security_events(), n=3, seconds=86400)


@query
def geofence_table(v):
    """The fences, one around each supplier's yard, that each position lies in."""
    inside = fences.inside_fences(v.fact_location_updates(), v.fences())
    return inside.select("id", "lock_id", "fence_id")


@query
def geofence_outside(v):
    """Positions of locks that lie in no fence at all."""
    return fences.outside_fences(v.fact_location_updates(), v.fences(), "id").select("id", "lock_id")


@query
def rolling_affected(v):
    return _days_as_text(trends.rolling_affected(v.security_events()))


@query
def incident_sessions(v):
    return motion.incident_sessions(v.security_events(), "12 hours")


# ---- alerts --------------------------------------------------------------------------------------


@query
def alert_tamper(v):
    return alerts.tamper_alert(v.security_events(), AS_OF, "6 HOURS")


@query
def alert_mass_offline(v):
    return alerts.mass_offline_alert(v.locks(), v.fact_lock_status_changes(), AS_OF, "12 HOURS", share=0.01)


@query
def alert_critical_burst(v):
    return alerts.critical_burst_alert(v.security_events(), n=2, window="1 hour", slide="10 minutes")


@query
def alert_battery(v):
    return alerts.battery_alert(v.locks(), v.security_events(), AS_OF)


@query
def alert_long_offline(v):
    return alerts.long_offline_alert(v.fact_lock_status_changes(), AS_OF)


# ---- streaming jobs run to the end of the given data ---------------------------------------------


@query
def stream_fact_events(v):
    return replay.fact_events(v)


@query
def stream_fact_accounting(v):
    return replay.fact_accounting(v)


@query
def stream_fact_retries(v):
    return replay.fact_retries(v)


@query
def stream_fact_status(v):
    return replay.fact_status_changes(v)


@query
def stream_fact_locations(v):
    return replay.fact_locations(v)


@query
def stream_hourly_trend(v):
    return replay.hourly_trend(v)


@query
def stream_sliding_critical(v):
    return replay.sliding_critical(v)


@query
def stream_status_durations(v):
    return replay.status_durations(v)


@query
def stream_distance_delta(v):
    return _rounded(replay.distance_delta(v), "distance_delta_m", "speed_kmh")


@query
def stream_enriched_events(v):
    return replay.enriched_events(v)


@query
def stream_assignments(v):
    return replay.assignments(v)


@query
def stream_incident_sessions(v):
    return replay.incident_sessions(v, "12 hours")


def _rule(rule, **changes):
    """A rule of the alert streams with times that the sparse test events can reach."""
    return dataclasses.replace(rule, **changes)


@query
def stream_alert_tamper(v):
    rule = _rule(conditions.TAMPER, hold=360 * conditions.MINUTE)
    on = replay.alert_periods(v, v.security_events().filter(rule.opens), "event_time", rule)
    return on.select("lock_id", "raised_at", "withdrawn_at", F.col("n").alias("tamper_events"))


@query
def stream_alert_long_offline(v):
    on = replay.alert_periods(v, v.fact_lock_status_changes(), "change_time", conditions.LONG_OFFLINE)
    return on.select("lock_id", F.col("since").alias("offline_since"), "raised_at", "withdrawn_at")


@query
def stream_alert_mass_offline(v):
    rule = _rule(conditions.MASS_OFFLINE, hold=720 * conditions.MINUTE)
    told = replay.share_alerts(v, v.fact_lock_status_changes(), "change_time", rule, 0.008)
    return told.select(F.col("at").alias("told_at"), "what", F.col("total").alias("offline_locks"), F.col("devices").alias("locks"), "share")


@query
def stream_alert_battery(v):
    rule = conditions.BATTERY
    told = replay.share_alerts(v, v.security_events().filter(rule.opens), "event_time", rule, 0.04)
    return told.select(F.col("at").alias("told_at"), "what", F.col("total").alias("battery_low_locks"), F.col("devices").alias("locks"), "share")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query):
        return lambda spark, sf_dir: fn(TestViews(configure(spark), sf_dir))

    return {name: bind(fn) for name, fn in QUERIES.items()}
