"""The documented summary per date and shipment on a few rows."""

from datetime import datetime

from fleetscope.plans import summaries


def on(day, hour=0):
    return datetime(2024, 1, day, hour)


def test_only_pieces_of_days_with_points_meet_the_running_totals(spark, monkeypatch):
    events = spark.createDataFrame(
        [("a", "battery_low", "critical", on(2, 10)), ("a", "battery_low", "low", on(2, 20)), (None, "battery_low", "low", on(2, 10))],
        "lock_id string, event_type string, severity string, event_time timestamp",
    )
    changes = spark.createDataFrame([("a", "offline", on(4, 1))], "lock_id string, status string, change_time timestamp")
    held = [
        (1, "a", on(1, 12), on(1, 18)),  # the lock has no point on that day
        (1, "a", on(2, 8), on(2, 12)),
        (2, "a", on(3, 6), on(4, 6)),  # two pieces, the second with a point
        (2, "b", on(2, 8), on(2, 12)),  # a lock without points
        (3, "c", on(2), on(3)),  # a whole day
    ]
    held = spark.createDataFrame(held, "shipment_pk long, lock_id string, assigned_at timestamp, released_at timestamp")
    shipments = spark.createDataFrame([(1, "S1"), (2, "S2"), (3, "S3")], "shipment_pk long, shipment_id string")
    history = spark.createDataFrame([], "shipment_id string, status string, effective_from timestamp, effective_to timestamp")

    laid, real = [], summaries.interval_totals

    def counting(points, intervals, *rest):
        laid.append(intervals.count())
        return real(points, intervals, *rest)

    monkeypatch.setattr(summaries, "interval_totals", counting)
    facts = summaries.daily_shipment_facts(events, held, changes, shipments, history, on(31).isoformat(" "))
    names = ["total_events", "critical_events", "warning_events", "status_changes", "compromised_locks", "total_locks"]
    got = {(r["date_key"] % 100, r["shipment_pk"]): tuple(r[n] for n in names) for r in facts.collect()}
    assert laid == [2]
    assert got == {
        (1, 1): (0, 0, 0, 0, 0, 1),
        (2, 1): (1, 1, 1, 0, 0, 1),
        (2, 2): (0, 0, 0, 0, 0, 1),
        (2, 3): (0, 0, 0, 0, 0, 1),
        (3, 2): (0, 0, 0, 0, 0, 1),
        (4, 2): (0, 0, 0, 1, 1, 1),
    }
