"""Streams whose rows come in any order, and alerts that the clock raises and ends."""

import os
import random
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from fleetscope.operators import changelog, motion
from fleetscope.plans import alerts
from fleetscope.sources.sinks import BatchTable, CarriedRows
from fleetscope.streaming import conditions, jobs, reorder
from fleetscope.streaming.conditions import LATE, MINUTE, RAISED, WITHDRAWN, Condition, Tracker

T0 = datetime(2024, 1, 1)
SMALL = reorder.Ordering(slice_seconds=120, lanes=2)
STATUS = "id long, lock_id string, status string, change_time timestamp"


def at(seconds):
    return T0 + timedelta(seconds=seconds)


class Lots:
    """A folder that gets one file, and so one micro-batch, per call."""

    def __init__(self, spark, path, schema, ts):
        self.spark, self.path, self.schema, self.ts, self.n = spark, str(path), schema, ts, 0
        os.makedirs(self.path)

    def add(self, rows):
        self.n += 1
        kinds = {"long": pa.int64(), "string": pa.string(), "timestamp": pa.timestamp("us", "UTC")}
        columns = [c.split() for c in self.schema.split(", ")]
        table = pa.table({c: pa.array([r[i] for r in rows], kinds[kind]) for i, (c, kind) in enumerate(columns)})
        file = os.path.join(self.path, f"part-{self.n:04d}.parquet")
        pq.write_table(table, file)
        os.utime(file, (1_700_000_000 + self.n, 1_700_000_000 + self.n))

    def clock(self, seconds):
        """A row of no lock that moves the clock; it takes effect in the batch after it."""
        columns = [c.split()[0] for c in self.schema.split(", ")]
        row = tuple(at(seconds) if c == self.ts else {"id": -1, "lock_id": None, "seq": -1}.get(c, "none") for c in columns)
        self.add([row])

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def shaken(rows, seconds, lots, rnd):
    """Rows in lots by a time of arrival up to ``seconds`` after their own."""
    arrived = sorted(rows, key=lambda r: r[-1].timestamp() + rnd.random() * seconds)
    size = -(-len(arrived) // lots)
    return [arrived[i : i + size] for i in range(0, len(arrived), size)]


def changes(n, rnd, locks="aabc"):
    out, now = [], 0
    for i in range(n):
        now += rnd.randrange(1, 60)
        out.append((i, rnd.choice(locks), rnd.choice(["active", "offline", "tampered"]), at(now)))
    return out


def test_rows_in_any_order_give_the_batch_result(spark, tmp_path):
    rnd = random.Random(6)
    rows = changes(300, rnd)
    feed = Lots(spark, tmp_path / "in", STATUS, "change_time")
    for lot in shaken(rows, 240, 5, rnd):
        feed.add(lot)
    feed.clock(10**8)
    sink, late = BatchTable(str(tmp_path / "out")), BatchTable(str(tmp_path / "late"))
    order = ["change_time", "id"]
    carried = CarriedRows(BatchTable(str(tmp_path / "state")), "lock_id", order, 2)
    query = jobs.start_neighbour_stream(feed.stream(), motion.status_durations, order, sink, carried, str(tmp_path / "c"), late=late, ordering=SMALL)
    query.awaitTermination()
    got = sink.read(spark)
    assert got.select("batch_id").distinct().count() >= 4
    assert rows_of(got.drop("batch_id")) == rows_of(motion.status_durations(spark.createDataFrame(rows, STATUS)))
    assert late.read(spark).count() == 0


def test_rows_behind_the_watermark_are_set_aside(spark, tmp_path):
    rnd = random.Random(7)
    rows = changes(120, rnd)
    behind = [(1000 + i, "a", "active", at(i)) for i in range(5)]
    feed = Lots(spark, tmp_path / "in", STATUS, "change_time")
    lots = shaken(rows, 60, 3, rnd)
    feed.add(lots[0])
    feed.add(lots[1])
    feed.add(lots[2] + behind)  # the first slices have gone on by now
    feed.clock(10**8)
    sink, late = BatchTable(str(tmp_path / "out")), BatchTable(str(tmp_path / "late"))
    order = ["change_time", "id"]
    carried = CarriedRows(BatchTable(str(tmp_path / "state")), "lock_id", order)
    jobs.start_neighbour_stream(
        feed.stream(), motion.status_durations, order, sink, carried, str(tmp_path / "c"), late=late, ordering=reorder.Ordering("2 minutes", lanes=3)
    ).awaitTermination()
    assert rows_of(late.read(spark).select("id")) == [(r[0],) for r in behind]
    assert rows_of(sink.read(spark).drop("batch_id")) == rows_of(motion.status_durations(spark.createDataFrame(rows, STATUS)))


def test_assignments_in_any_order(spark, tmp_path, split_small):
    rnd = random.Random(8)
    schema = "lock_id string, action string, shipment_id string, seq long, change_time timestamp"
    rows, now = [], 0
    for i in range(200):
        now += rnd.randrange(1, 60)
        lock = "hot" if rnd.random() < 0.6 else rnd.choice("abc")
        rows.append((lock, rnd.choice(["assigned", "released"]), rnd.choice(["S1", "S2"]), i, at(now)))
    feed = Lots(spark, tmp_path / "in", schema, "change_time")
    for lot in shaken(rows, 240, 3, rnd):
        feed.add(lot)
    feed.clock(10**8)
    ships = spark.createDataFrame([("S1",), ("S2",)], "shipment_id string")
    sink, late = BatchTable(str(tmp_path / "out")), BatchTable(str(tmp_path / "late"))
    order = ["change_time", "seq"]
    carried = CarriedRows(BatchTable(str(tmp_path / "state")), "lock_id", order)
    jobs.start_assignment_stream(
        feed.stream(), lambda: ships, order, sink, carried, str(tmp_path / "c"), late=late, ordering=SMALL
    ).awaitTermination()
    got = changelog.pair_operations(sink.read(spark), order)
    want = changelog.assignments_from_log(spark.createDataFrame(rows, schema), ships, order)
    assert rows_of(got) == rows_of(want) and late.read(spark).count() == 0


# ---- conditions ------------------------------------------------------------------------------------

RULES = [
    Condition("stays", "true", hold=100),
    Condition("waits", "true", lag=70),
    Condition("both", "true", lag=30, hold=90),
    Condition("open", "true"),
]


def holds(rule, rows, t):
    """Whether the condition holds at ``t``, from all rows at once."""
    past = [(a, o) for a, o in rows if a <= t]
    if not past:
        return False
    last, opens = past[-1]
    return opens and t >= last + rule.lag and (rule.hold is None or t < last + rule.hold)


@pytest.mark.parametrize("rule", RULES, ids=lambda r: r.name)
def test_tracker_equals_the_rule_at_every_time(rule):
    rnd = random.Random(2)
    for _ in range(200):
        times = sorted(rnd.sample(range(400), rnd.randint(0, 9)))
        rows = [(a, rnd.random() < 0.7) for a in times]
        tracker, clock = Tracker(rule), 0
        for a, opens in rows:
            if rnd.random() < 0.5:  # the clock also ticks between rows, and state is kept in between
                tracker.advance(rnd.randrange(clock, a) if a > clock else clock)
                fresh = Tracker(rule, tracker.state())
                fresh.out, tracker = tracker.out, fresh
            tracker.row(a, opens)
            clock = a
        tracker.advance(1000)
        flips = [(a, 1 if what == RAISED else -1) for what, a, _, _ in tracker.out]
        for t in range(0, 600):
            assert sum(s for a, s in flips if a <= t) == holds(rule, rows, t), (rows, t, tracker.out)


def run_alert(spark, tmp_path, feed, rule, ts="change_time", **more):
    sink = BatchTable(str(tmp_path / "out"))
    jobs.start_alert_stream(feed.stream(), rule, ts, sink, str(tmp_path / "c"), **more).awaitTermination()
    return sink.read(spark)


def test_a_lock_that_goes_silent_is_reported(spark, tmp_path):
    feed = Lots(spark, tmp_path / "in", STATUS, "change_time")
    feed.add([(1, "a", "active", at(0)), (2, "a", "offline", at(60)), (3, "b", "offline", at(60)), (4, "c", "active", at(60))])
    feed.add([(5, "b", "active", at(60 + 1799))])  # b is back a second before it would be reported
    feed.clock(60 + 1800 + 700)  # nothing more of a
    table = run_alert(spark, tmp_path, feed, conditions.LONG_OFFLINE)
    on = conditions.periods(table, "lock_id")
    assert rows_of(on.drop("n")) == [("a", at(60), at(60 + 1800), None)]
    # the same as the batch query at that time, and it is withdrawn when the lock is back
    log = spark.read.schema(STATUS).parquet(feed.path)
    assert [r["lock_id"] for r in alerts.long_offline_alert(log, "2024-01-01 00:35:00").filter("lock_id is not null").collect()] == ["a"]
    feed.add([(6, "a", "active", at(4000)), (7, "a", "offline", at(4001)), (8, "a", "active", at(4002))])
    feed.clock(10**6)
    table = run_alert(spark, tmp_path, feed, conditions.LONG_OFFLINE)
    assert rows_of(conditions.periods(table, "lock_id").drop("n")) == [("a", at(60), at(1860), at(4000))]


def test_tamper_alerts_in_any_order_and_late(spark, tmp_path):
    rnd = random.Random(3)
    schema = "id long, lock_id string, event_type string, event_time timestamp"
    rows, now = [], 0
    for i in range(200):
        now += rnd.randrange(1, 50)
        rows.append((i, rnd.choice("ab"), "tamper_detected", at(now)))
    feed = Lots(spark, tmp_path / "in", schema, "event_time")
    for lot in shaken(rows, 300, 4, rnd):
        feed.add(lot)
    feed.clock(10**8)
    feed.add([(900, "a", "tamper_detected", at(5))])
    table = run_alert(spark, tmp_path, feed, conditions.TAMPER, "event_time")
    assert table.filter(table.what == LATE).count() == 1
    want = []
    for lock in "ab":
        own = [r[3] for r in rows if r[1] == lock]
        for t in own:
            if want and want[-1][0] == lock and t <= want[-1][2]:
                want[-1] = (lock, want[-1][1], t + timedelta(minutes=1), want[-1][3] + 1)
            else:
                want.append((lock, t, t + timedelta(minutes=1), 1))
    got = conditions.periods(table, "lock_id").select("lock_id", "raised_at", "withdrawn_at", "n")
    assert rows_of(got) == sorted(want, key=repr)


def test_share_alert_rereads_the_devices(spark, tmp_path):
    feed = Lots(spark, tmp_path / "in", STATUS, "change_time")
    feed.add([(1, "a", "offline", at(10)), (2, "b", "offline", at(100))])
    feed.clock(1000)
    feed.add([(3, "c", "offline", at(2000))])
    feed.clock(10**6)
    sizes = []

    def locks():
        sizes.append(4 if len(sizes) < 3 else 1)  # one lock is left by the time c goes offline
        return spark.range(sizes[-1])

    sink, state = BatchTable(str(tmp_path / "out")), BatchTable(str(tmp_path / "state"))
    jobs.start_share_alert_stream(
        feed.stream(), conditions.MASS_OFFLINE, "change_time", locks, 0.4, sink, state, str(tmp_path / "c")
    ).awaitTermination()
    got = sorted(map(tuple, sink.read(spark).select("at", "what", "total", "devices").collect()))
    assert got == [
        (at(120), RAISED, 2, 4),  # a and b, seen at the next whole minute
        (at(360), WITHDRAWN, 1, 4),  # five minutes after a
        (at(2040), RAISED, 1, 1),
        (at(2340), WITHDRAWN, 0, 1),
    ]
    assert conditions.MASS_OFFLINE.hold == 5 * MINUTE and WITHDRAWN != LATE
