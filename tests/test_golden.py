"""Hand-written rows for the corner cases."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetscope import model
from fleetscope.functions import scoring
from fleetscope.functions.timecols import day_of_week0
from fleetscope.operators import changelog, dims, motion, quality
from fleetscope.operators.asof import asof_join, interval_join
from fleetscope.plans import alerts, health, sequences, summaries, trends

AS_OF = "2024-01-10 12:00:00"


def ts(text):
    return datetime.fromisoformat(f"2024-01-{text}")


def tuples(df):
    return [tuple(r) for r in df.collect()]


EVENTS = "id string, lock_id string, event_type string, severity string, event_time timestamp"
CHANGES = "id int, lock_id string, status string, shipment_id string, change_time timestamp"
MOVES = "id int, lock_id string, latitude double, longitude double, update_time timestamp"


@pytest.fixture(scope="module")
def fleet(spark):
    dim = spark.createDataFrame(
        [("S1", "stop", True), ("S2", "loading", True), ("S3", "stop", True), ("S4", "old", False)],
        "shipment_id string, status string, is_current boolean",
    )
    changes = spark.createDataFrame(
        [(1, "a", "active", "S1", ts("01")), (2, "a", "offline", "S1", ts("02")), (3, "b", "active", "S2", ts("01"))],
        CHANGES,
    )
    events = spark.createDataFrame(
        [("1", "a", "tamper_detected", "critical", ts("03")), ("2", "a", "battery_low", "high", ts("04"))], EVENTS
    )
    moves = spark.createDataFrame([(1, "a", 1.0, 1.0, ts("03")), (2, "a", 2.0, 2.0, ts("05")), (3, "a", 3.0, 3.0, ts("06"))], MOVES)
    return dim, changes, events.withColumnRenamed("id", "event_id"), moves


def test_health_multiplies_like_the_view(fleet):
    got = {r["shipment_id"]: r for r in health.shipment_health(*fleet).collect()}
    # 2 status rows x 2 events x 3 positions
    assert got["S1"]["total_security_events"] == 12
    assert got["S1"]["critical_events"] == 6 and got["S1"]["high_events"] == 6
    assert got["S1"]["health_score"] == 0 and got["S1"]["active_locks"] == 1
    assert got["S1"]["last_location_update"] == ts("06")


def test_health_without_events_scores_99(fleet):
    got = {r["shipment_id"]: r for r in health.shipment_health(*fleet).collect()}
    for shipment in ("S2", "S3"):
        assert got[shipment]["health_score"] == 99 and got[shipment]["total_security_events"] == 0
        assert got[shipment]["last_security_event"] is None
    assert "S4" not in got


def test_health_dedup_counts_each_event_once(fleet):
    got = {r["shipment_id"]: r["health_score"] for r in health.shipment_health(*fleet, fanout=False).collect()}
    assert got == {"S1": 65, "S2": 100, "S3": 100}


def test_rewrite_equals_literal_join(spark, fleet):
    for name, df in zip(("ds", "flsc", "fse", "flu"), fleet):
        df.createOrReplaceTempView(f"t_{name}")
    literal = spark.sql(
        """select ds.shipment_id, count(fse.event_id) as n,
             greatest(0, 100 - sum(case fse.severity when 'critical' then 25 when 'high' then 10
               when 'medium' then 3 else 1 end)) as s
           from t_ds ds left join t_flsc flsc on flsc.shipment_id = ds.shipment_id
           left join t_fse fse on fse.lock_id = flsc.lock_id left join t_flu flu on flu.lock_id = flsc.lock_id
           where ds.is_current group by ds.shipment_id, ds.status"""
    )
    ours = health.shipment_health(*fleet).select("shipment_id", "total_security_events", "health_score")
    assert sorted(tuples(literal)) == sorted(tuples(ours))


def test_labels_at_the_limits(spark):
    df = spark.createDataFrame([(80,), (79,), (50,), (49,), (None,)], "health_score int")
    labels = [r[0] for r in df.select(scoring.health_label()).collect()]
    assert labels == ["HEALTHY", "WARNING", "WARNING", "CRITICAL", "CRITICAL"]


def test_api_health_rules(spark):
    shipments = spark.createDataFrame([(1, "S1"), (2, "S2"), (3, "S3"), (4, "S4")], "shipment_pk int, shipment_id string")
    held = spark.createDataFrame(
        [(1, "bad", None), (1, "bad", None), (1, "good", None), (2, "good", None), (3, "bad", ts("02")), (4, "weak", None)],
        "shipment_pk int, lock_id string, released_at timestamp",
    )
    locks = spark.createDataFrame([("bad", "tampered"), ("good", "active"), ("weak", "offline")], "id string, status string")
    events = spark.createDataFrame(
        [
            ("1", "bad", "unlock_attempt", "low", ts("10 11:00:00")),  # exactly one hour old: out
            ("2", "bad", "unlock_attempt", "low", ts("10 11:00:01")),
            ("3", "bad", "battery_low", "low", ts("10 11:30:00")),
            ("4", "good", "unlock_attempt", "critical", ts("10 11:30:00")),  # lock not compromised
            ("5", "weak", "connection_lost", "critical", ts("10 11:30:00")),
        ],
        EVENTS,
    )
    got = sorted(tuples(health.api_shipment_health(shipments, held, locks, events, AS_OF)))
    assert got == [("S1", 2, 1, 1, "critical"), ("S2", 1, 0, 0, "ok"), ("S4", 1, 1, 0, "warning")]


def test_trailing_limits(spark):
    events = spark.createDataFrame([("1", "a", "battery_low", "low", ts("03 12:00:00"))], EVENTS)
    assert trends.top_types_7d(events, dims.dim_event_type(spark), AS_OF).count() == 1
    assert trends.top_types_7d(events, dims.dim_event_type(spark), AS_OF, approx=True).count() == 1
    assert trends.top_types_7d(events, dims.dim_event_type(spark), "2024-01-10 12:00:01").count() == 0


def test_partition_bound_is_implied(spark):
    events = spark.createDataFrame([("1", "a", "battery_low", "low", ts("10 11:30:00"), 20240110)], EVENTS + ", date_key int")
    plan = alerts.tamper_alert(events, AS_OF, "1 HOUR")
    assert "date_key" in plan._jdf.queryExecution().analyzed().toString()
    assert trends.events_per_minute(events, AS_OF).count() == 1


def test_events_by_severity(spark):
    events = spark.createDataFrame([("1", "a", "battery_low", "low", ts("03")), ("2", "a", "battery_low", "high", ts("03"))], EVENTS)
    assert trends.events_by_severity(events).count() == 2
    assert tuples(trends.events_by_severity(events, "high").select("id")) == [("2",)]
    with pytest.raises(ValueError):
        trends.events_by_severity(events, "fatal")


def test_dates_outside_the_dimension_drop(spark):
    events = spark.createDataFrame(
        [("1", "a", "battery_low", "low", datetime(2023, 12, 31, 23)), ("2", "a", "battery_low", "low", datetime(2028, 1, 1)), ("3", "a", "battery_low", "low", ts("01"))],
        EVENTS,
    )
    trend = trends.hourly_event_trend(events, dims.dim_date(spark), dims.dim_event_type(spark))
    assert [r["event_hour"] for r in trend.collect()] == [ts("01")]


def test_dim_date(spark):
    dim = dims.dim_date(spark)
    assert dim.count() == 1461
    days = {r["date_key"]: (r["day_of_week"], r["is_weekend"]) for r in dim.collect()}
    assert days[20240107] == (0, True) and days[20240106] == (6, True) and days[20240108] == (1, False)
    assert dim.select(day_of_week0("full_date").alias("d")).agg(F.min("d"), F.max("d")).first() == (0, 6)


def test_spikes_skip_the_first_hour_and_empty_hours(spark):
    rows = []
    for hour, n in [(0, 50), (1, 1), (5, 1), (9, 60)]:
        rows += [(f"{hour}-{i}", "a", "tamper_detected", "critical", ts(f"01 {hour:02d}:10:00")) for i in range(n)]
    got = tuples(trends.critical_spikes(spark.createDataFrame(rows, EVENTS)))
    assert got == [(ts("01 09:00:00"), 60, 17.33, 3.46)]


def test_utilization(spark):
    held = spark.createDataFrame(
        [
            ("open", ts("10 11:00:00"), None),
            ("zero", ts("02"), ts("02")),
            ("twice", ts("02 00:00:00"), ts("02 02:00:00")),
            ("twice", ts("02 01:00:00"), ts("02 03:00:00")),
            ("half", ts("02 00:00:00"), ts("02 01:00:00")),
            ("half", ts("02 03:00:00"), ts("02 04:00:00")),
        ],
        "lock_id string, assigned_at timestamp, released_at timestamp",
    )
    got = {r[0]: tuple(r)[1:5] for r in summaries.lock_utilization(held, AS_OF).collect()}
    assert got == {
        "open": (1, 1.0, 1.0, 1.0),
        "zero": (1, 0.0, 0.0, 0.0),
        "twice": (2, 2.0, 1.0, 4.0),
        "half": (2, 1.0, 0.5, 2.0),
    }
    buckets = summaries.utilization_histogram(summaries.lock_utilization(held, AS_OF))
    assert sorted(tuples(buckets)) == [(1, 1), (6, 1), (10, 2)]


LOG = "lock_id string, action string, status string, latitude double, longitude double, shipment_id string, change_time timestamp, seq int"
ORDER = ["change_time", "seq"]


def test_lock_fold(spark):
    log = spark.createDataFrame(
        [
            ("a", "status_changed", "tampered", None, None, None, ts("01"), 1),  # before creation
            ("a", "created", "inactive", 1.0, 2.0, None, ts("02"), 2),
            ("a", "created", "active", 9.0, 9.0, None, ts("03"), 3),  # second creation
            ("b", "created", "inactive", None, None, None, ts("02"), 4),
            ("b", "status_changed", "offline", None, None, None, ts("04"), 5),
            ("b", "status_changed", "active", None, None, None, ts("03"), 6),
            ("c", "status_changed", "active", None, None, None, ts("03"), 7),  # never created
        ],
        LOG,
    )
    assert sorted(tuples(changelog.current_locks(log, ORDER))) == [("a", "inactive", ts("02")), ("b", "offline", ts("04"))]
    by_arrival = dict((r[0], r[1]) for r in changelog.current_locks(log, ["seq"]).collect())
    assert by_arrival == {"a": "inactive", "b": "active"}
    moves = spark.createDataFrame(
        [("b", 5.0, 6.0, ts("05"), 8), ("b", 7.0, 8.0, ts("01"), 9), ("c", 1.0, 1.0, ts("05"), 10)],
        "lock_id string, latitude double, longitude double, change_time timestamp, seq int",
    )
    assert sorted(tuples(changelog.current_locations(log, moves, ORDER))) == [("a", 1.0, 2.0), ("b", 5.0, 6.0)]


def test_assignment_rules(spark):
    rows = [
        ("assigned", None, "01"),  # no shipment
        ("assigned", "S9", "02"),  # unknown shipment
        ("released", "S1", "03"),  # nothing open
        ("assigned", "S1", "04"),
        ("assigned", "S2", "05"),  # while assigned
        ("released", "S2", "06"),  # other shipment
        ("released", "S1", "07"),
        ("assigned", "S2", "08"),
    ]
    log = spark.createDataFrame([("a", act, None, None, None, s, ts(d), i) for i, (act, s, d) in enumerate(rows)], LOG)
    known = spark.createDataFrame([("S1",), ("S2",)], "shipment_id string")
    got = dims.with_active_flag(changelog.assignments_from_log(log, known, ORDER))
    assert sorted(tuples(got)) == [("a", "S1", ts("04"), ts("07"), False), ("a", "S2", ts("08"), None, True)]


def test_scd2(spark):
    changes = spark.createDataFrame(
        [
            (1, "a", "active", None, ts("01")),
            (2, "a", "active", None, ts("02")),  # no change
            (3, "a", "offline", None, ts("03")),
            (4, "a", "tampered", None, ts("03")),  # same time: the later row counts
            (5, "a", "active", None, ts("04")),
        ],
        CHANGES,
    )
    dim = dims.scd2(changes, "lock_id", ["status"], "change_time", "id")
    end = datetime.fromisoformat(model.OPEN_END)
    assert sorted(tuples(dim), key=lambda r: r[2]) == [
        ("a", "active", ts("01"), ts("03"), False),
        ("a", "tampered", ts("03"), ts("04"), False),
        ("a", "active", ts("04"), end, True),
    ]
    assert dims.current(dim).count() == 1


def test_merge_dimension(spark):
    old = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, status string")
    new = spark.createDataFrame([("b", None), ("c", "z")], "id string, status string")
    assert sorted(tuples(dims.merge_dimension(old, new, "id"))) == [("a", "x"), ("b", None), ("c", "z")]


def test_duplicates_orphans_and_ranges(spark):
    events = spark.createDataFrame(
        [("1", "a", "battery_low", "low", ts("02")), ("1", "a", "battery_low", "high", ts("01")), ("2", "x", "battery_low", "low", ts("01"))],
        EVENTS,
    )
    locks = spark.createDataFrame([("a",)], "id string")
    kept, orphans = quality.enforce_fk(events, locks, "lock_id", "id")
    assert tuples(orphans.select("id", "reason")) == [("2", "unknown lock_id")]
    first = quality.insert_ignore(kept, events.filter(F.lit(False)), "id", order=["event_time"])
    assert tuples(first.select("id", "severity")) == [("1", "high")]
    assert quality.insert_ignore(kept, kept, "id").count() == 0

    moves = spark.createDataFrame([(90.0, 0.0), (90.1, 0.0), (0.0, -180.1), (None, 0.0)], "latitude double, longitude double")
    rules = [quality.required("latitude"), quality.between("latitude", -90, 90), quality.between("longitude", -180, 180)]
    valid, bad = quality.validate(moves, rules)
    assert tuples(valid) == [(90.0, 0.0)]
    assert [r["reason"] for r in bad.collect()] == ["latitude out of range", "longitude out of range", "missing latitude"]


def test_asof_edges(spark):
    events = spark.createDataFrame(
        [("1", "a", "battery_low", "low", ts("01")), ("2", "a", "battery_low", "low", ts("02")), ("3", "b", "battery_low", "low", ts("05"))],
        EVENTS,
    )
    moves = spark.createDataFrame([(1, "a", 1.0, 1.0, ts("02")), (2, "a", 2.0, 2.0, ts("02")), (3, "a", 3.0, 3.0, ts("03"))], MOVES)
    got = asof_join(events, moves, "lock_id", "event_time", "update_time", ["latitude"], "id")
    assert {r["id"]: r["latitude"] for r in got.collect()} == {"1": None, "2": 2.0, "3": None}


def test_interval_edges(spark):
    events = spark.createDataFrame([(str(i), "a", "battery_low", "low", ts(f"0{i} 00:00:00")) for i in range(1, 6)], EVENTS)
    held = spark.createDataFrame(
        [("a", 1, ts("02"), ts("04")), ("a", 2, ts("04"), None), ("a", 3, ts("03"), ts("03"))],
        "lock_id string, shipment_pk int, assigned_at timestamp, released_at timestamp",
    )
    got = interval_join(events, held, "lock_id", "event_time", "assigned_at", "released_at", ["shipment_pk"])
    assert {r["id"]: r["shipment_pk"] for r in got.collect()} == {"1": None, "2": 1, "3": 1, "4": 2, "5": 2}


def test_battery_fires_once_per_threshold(spark):
    readings = spark.createDataFrame(
        [(i, "a", pct, ts(f"0{i}")) for i, pct in enumerate([50, 20, 15, 25, 4, 3], 1)],
        "id int, lock_id string, battery_pct int, reading_time timestamp",
    )
    got = sorted(tuples(motion.battery_crossings(readings)), key=lambda r: -r[1])
    assert got == [
        ("a", 20, ts("02"), 20, "medium"),
        ("a", 10, ts("05"), 4, "high"),
        ("a", 5, ts("05"), 4, "critical"),
    ]


def test_incident_burst_in_thirty_seconds(spark):
    rows = [(f"{i:02d}", "a", "tamper_detected", "high", ts(f"01 00:00:{i * 2:02d}")) for i in range(16)]
    rows.append(("99", "a", "tamper_detected", "low", ts("01 00:00:05")))
    got = motion.incident_bursts(spark.createDataFrame(rows, EVENTS))
    assert sorted(r["id"] for r in got.collect()) == ["14", "15"]


def test_distance_and_speed(spark):
    moves = spark.createDataFrame([(1, "a", 0.0, 0.0, ts("01 00:00:00")), (2, "a", 0.0, 1.0, ts("01 01:00:00")), (3, "a", 0.0, 1.0, ts("01 01:00:00"))], MOVES)
    got = {r["update_time"]: r for r in motion.distance_delta(moves).filter("distance_delta_m > 0").collect()}
    row = got[ts("01 01:00:00")]
    assert row["distance_delta_m"] == pytest.approx(111_194.93, abs=0.01)
    assert row["speed_kmh"] == pytest.approx(111.195, abs=0.001)
    assert motion.distance_delta(moves).filter("speed_kmh is null").count() == 2


def test_route_ends_and_middle(spark):
    points = spark.createDataFrame([("r", 0, 0.0, 0.0), ("r", 1, 0.0, 3.0), ("r", 2, 1.0, 3.0)], "route string, seq int, latitude double, longitude double")
    asked = [-0.5, 0.0, 0.375, 0.75, 0.875, 1.0, 1.5]
    progress = spark.createDataFrame([("r", p) for p in asked], "route string, progress double")
    got = {r["progress"]: (r["expected_lat"], r["expected_lon"]) for r in motion.route_position(progress, motion.route_segments(points)).collect()}
    assert got == {-0.5: (0, 0), 0.0: (0, 0), 0.375: (0, 1.5), 0.75: (0, 3), 0.875: (0.5, 3), 1.0: (1, 3), 1.5: (1, 3)}


def test_mtbf_needs_two_failures(spark):
    events = spark.createDataFrame(
        [("1", "a", "tamper_detected", "low", ts("01 00:00:00")), ("2", "a", "tamper_detected", "low", ts("01 00:01:00")), ("3", "a", "tamper_detected", "low", ts("01 00:03:00")), ("4", "b", "tamper_detected", "low", ts("01"))],
        EVENTS,
    )
    assert sorted(tuples(summaries.lock_mtbf(events))) == [("a", 3, 90.0), ("b", 1, None)]


def test_ranks_with_ties(spark):
    rows = [(f"{lock}{i}", lock, "battery_low", "low", ts("01")) for lock, n in [("a", 3), ("b", 2), ("c", 2), ("d", 1)] for i in range(n)]
    got = tuples(sequences.rank_locks(spark.createDataFrame(rows, EVENTS)))
    assert got == [("a", 3, 1, 1), ("b", 2, 2, 2), ("c", 2, 2, 2), ("d", 1, 4, 3)]


def test_compromised_without_events_stay(spark):
    locks = spark.createDataFrame([("a", "offline"), ("b", "active")], "id string, status string")
    events = spark.createDataFrame([], EVENTS)
    assert tuples(summaries.compromised_recent(locks, events, AS_OF)) == [("a", "offline", 0, [])]


def test_offline_and_share_alerts(spark):
    changes = spark.createDataFrame(
        [(1, "a", "offline", None, ts("10 11:30:00")), (2, "b", "offline", None, ts("10 11:29:59")), (3, "c", "offline", None, ts("10 11:00:00")), (4, "c", "active", None, ts("10 11:59:00"))],
        CHANGES,
    )
    assert tuples(alerts.long_offline_alert(changes, AS_OF).select("lock_id", "offline_seconds")) == [("b", 1801)]
    locks = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    assert tuples(alerts.mass_offline_alert(locks, changes, AS_OF, "30 MINUTES")) == [(4, 1, 0.25, True)]
    assert tuples(alerts.mass_offline_alert(locks, changes, AS_OF)) == [(4, 0, 0.0, False)]
