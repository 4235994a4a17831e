"""Streaming jobs over several micro-batches: late data, replays, and state carried across batches."""

import os
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetscope.operators import changelog, motion
from fleetscope.sources.sinks import BatchTable, CarriedRows
from fleetscope.sources.topics import JsonFolder, read_topic
from fleetscope.streaming import jobs

T0 = datetime(2024, 1, 1)


def millis(seconds):
    return int((T0 - datetime(1970, 1, 1)).total_seconds() * 1000) + seconds * 1000


class Feed:
    """A folder that gets one file, and so one micro-batch, per call."""

    def __init__(self, spark, root, record):
        self.spark, self.path, self.record, self.n = spark, os.path.join(root, record), record, 0
        os.makedirs(self.path)

    def add(self, rows):
        import json

        self.n += 1
        file = os.path.join(self.path, f"part-{self.n:04d}.json")
        with open(file, "w") as out:
            out.writelines(json.dumps(r) + "\n" for r in rows)
        os.utime(file, (1_700_000_000 + self.n, 1_700_000_000 + self.n))

    def stream(self):
        return read_topic(self.spark, JsonFolder(self.path, max_files=1), self.record, streaming=True)


def event(i, seconds, lock="a", kind="tamper_detected", severity="critical"):
    return {"event_id": str(i), "lock_id": lock, "event_type": kind, "severity": severity, "timestamp": millis(seconds)}


def finish(query):
    query.awaitTermination()
    return query


def test_facts_reject_and_deduplicate(spark, tmp_path):
    feed = Feed(spark, tmp_path, "security_event")
    feed.add([event(1, 0), event(2, 10), event(2, 10), event(3, 20, kind="unheard_of"), event(4, 20, lock="ghost")])
    feed.add([event(1, 0), event(5, 30), {"event_id": "6", "lock_id": None, "event_type": "battery_low", "severity": "low", "timestamp": millis(40)}])
    locks = spark.createDataFrame([("a",)], "id string")
    sink = BatchTable(str(tmp_path / "facts"))
    finish(jobs.start_fact_stream(feed.stream(), "security_event", sink, str(tmp_path / "c"), known_locks=lambda: locks))
    table = sink.read(spark)
    facts = jobs.facts(table)
    assert sorted(r["event_id"] for r in facts.collect()) == ["1", "2", "5"]
    assert facts.select("date_key").distinct().collect()[0][0] == 20240101
    dead = {r["event_id"]: r["reason"] for r in jobs.dead_letters(table).collect()}
    assert dead == {"3": "unknown event_type", "4": "unknown lock_id", "6": "missing lock_id"}


def test_rows_of_unknown_locks_are_tried_again(spark, tmp_path):
    feed = Feed(spark, tmp_path, "security_event")
    feed.add([event(1, 0), event(2, 0, lock="late"), event(3, 0, lock="never"), event(4, 0, kind="unheard_of", lock="never")])
    feed.add([event(2, 0, lock="late"), event(5, 10, lock="later")])  # 2 is delivered again while it waits
    feed.add([event(6, 20)])
    feed.add([event(7, 30, lock="never")])
    known = iter([["a"], ["a"], ["a", "late"], ["a", "late", "later"]])
    load = lambda: spark.createDataFrame([(x,) for x in next(known)], "id string")
    sink, waiting = BatchTable(str(tmp_path / "facts")), BatchTable(str(tmp_path / "waiting"))
    finish(jobs.start_fact_stream(feed.stream(), "security_event", sink, str(tmp_path / "c"), known_locks=load, waiting=waiting))
    table = sink.read(spark)
    got = sorted((r["event_id"], r["verdict"], r["batch_id"]) for r in table.collect())
    assert got == [
        ("1", "valid", 0),
        ("2", "repeated", 2),
        ("2", "valid", 2),
        ("3", "rejected", 2),  # after three tries
        ("4", "rejected", 0),  # breaks a rule, waiting would not help
        ("5", "valid", 3),
        ("6", "valid", 2),
    ]
    left = jobs.still_waiting(waiting, table.drop("batch_id", "verdict", "reason", "date_key"), 3)
    assert [(r["event_id"], r["attempts"]) for r in left.collect()] == [("7", 1)]


def test_facts_resume_from_checkpoint(spark, tmp_path):
    feed = Feed(spark, tmp_path, "location_update")
    sink = BatchTable(str(tmp_path / "facts"))

    def run():
        finish(jobs.start_fact_stream(feed.stream(), "location_update", sink, str(tmp_path / "c")))
        return jobs.facts(sink.read(spark)).count()

    feed.add([{"lock_id": "a", "latitude": 1.0, "longitude": 1.0, "timestamp": millis(0)}])
    assert run() == 1
    feed.add([{"lock_id": "a", "latitude": 2.0, "longitude": 1.0, "timestamp": millis(9)}])
    assert run() == 2 and run() == 2


def test_replayed_batch_does_not_double(spark, tmp_path):
    sink = BatchTable(str(tmp_path / "t"))
    rows = spark.range(10)
    sink.write(rows, 0)
    sink.write(rows, 1)
    sink.write(rows, 1)
    assert sink.read(spark).count() == 20


def test_late_events_and_watermark(spark, tmp_path):
    feed = Feed(spark, tmp_path, "security_event")
    hour = 3600
    feed.add([event(1, 100), event(2, hour + 300)])
    feed.add([event(3, hour - 240, severity="low")])  # 9 minutes late: its hour is still open
    feed.add([event(4, hour + 1500)])  # watermark moves to 1:15
    feed.add([event(5, hour + 1501)])
    feed.add([event(6, hour + 541, severity="high"), event(7, hour - 1, severity="high")])  # 16 and 25 minutes late
    sink = BatchTable(str(tmp_path / "t"))
    finish(jobs.start_upserts(jobs.hourly_trend(feed.stream()), sink, str(tmp_path / "c")))
    got = sink.latest(spark, ["event_hour", "event_type", "severity"])
    counts = {(r["event_hour"].hour, r["severity"]): r["event_count"] for r in got.collect()}
    # event 6 is late but its hour has not ended; the hour of event 7 was closed before it came
    assert counts == {(0, "critical"): 1, (0, "low"): 1, (1, "critical"): 3, (1, "high"): 1}


def test_append_mode_closes_windows(spark, tmp_path):
    feed = Feed(spark, tmp_path, "security_event")
    feed.add([event(1, 100)])
    feed.add([event(2, 9000)])
    feed.add([event(3, 9001)])
    sink = BatchTable(str(tmp_path / "t"))
    trend = jobs.hourly_trend(feed.stream())
    finish(jobs.start(trend, lambda b, i: sink.write(b, i), str(tmp_path / "c"), None, "append"))
    assert [r["event_hour"].hour for r in sink.read(spark).collect()] == [0]


@pytest.mark.parametrize("compact", [1, 3])
def test_durations_across_batches_equal_batch(spark, tmp_path, compact):
    rnd = random.Random(3)
    rows, at = [], 0
    for i in range(120):
        at += rnd.randrange(1, 100)
        rows.append((i, rnd.choice("abc"), rnd.choice(["active", "offline"]), T0 + timedelta(seconds=at)))
    schema = "id int, lock_id string, status string, change_time timestamp"
    for n in range(8):
        part = spark.createDataFrame(rows[n * 15 : n * 15 + 15], schema).coalesce(1)
        part.write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)  # files are taken in order of their times
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    order = ["change_time", "id"]
    sink = BatchTable(str(tmp_path / "out"))
    carried = CarriedRows(BatchTable(str(tmp_path / "state")), "lock_id", order, compact)
    finish(jobs.start_neighbour_stream(stream, motion.status_durations, order, sink, carried, str(tmp_path / "c")))
    got = sink.read(spark)
    assert got.select("batch_id").distinct().count() == 8
    want = motion.status_durations(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, got.drop("batch_id").collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_assignments_across_batches_equal_batch(spark, tmp_path, split_small):
    rnd = random.Random(4)
    feed = Feed(spark, tmp_path, "lock_status_change")
    at = 0
    for _ in range(4):
        rows = []
        for _ in range(40):
            at += rnd.randrange(1, 60)
            lock = "hot" if rnd.random() < 0.6 else rnd.choice("abc")
            action = rnd.choice(["assigned", "released"])
            rows.append({"lock_id": lock, "action": action, "shipment_id": rnd.choice(["S1", "S2"]), "timestamp": millis(at)})
        feed.add(rows)
    ships = spark.createDataFrame([("S1",), ("S2",)], "shipment_id string")
    sink = BatchTable(str(tmp_path / "out"))
    order = ["change_time"]
    carried = CarriedRows(BatchTable(str(tmp_path / "state")), "lock_id", order, 2)
    finish(jobs.start_assignment_stream(feed.stream(), lambda: ships, order, sink, carried, str(tmp_path / "c")))
    got = changelog.pair_operations(sink.read(spark), order)
    log = read_topic(spark, JsonFolder(feed.path), "lock_status_change")
    want = changelog.assignments_from_log(log, ships, order)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_enrichment_rereads_the_dimension(spark, tmp_path):
    feed = Feed(spark, tmp_path, "security_event")
    feed.add([event(1, 0)])
    feed.add([event(2, 10, kind="battery_low"), event(3, 10, lock="zzz")])
    states = iter(["active", "tampered"])
    load = lambda: spark.createDataFrame([("a", next(states))], "id string, status string")
    sink = BatchTable(str(tmp_path / "t"))
    finish(jobs.start_enriched_stream(feed.stream(), load, sink, str(tmp_path / "c")))
    got = {r["event_id"]: (r["lock_status"], r["event_class"]) for r in sink.read(spark).collect()}
    assert got == {"1": ("active", "CRITICAL"), "2": ("tampered", "WARNING"), "3": (None, "CRITICAL")}


def test_sliding_windows(spark, tmp_path):
    feed = Feed(spark, tmp_path, "security_event")
    feed.add([event(1, 600), event(2, 660), event(3, 661, severity="low")])
    sink = BatchTable(str(tmp_path / "t"))
    finish(jobs.start_upserts(jobs.sliding_critical(feed.stream()), sink, str(tmp_path / "c")))
    got = sink.latest(spark, ["window_start", "window_end"])
    assert got.agg(F.sum("critical_events"), F.max("critical_events"), F.count("*")).first() == (20, 2, 11)


def test_no_event_is_lost_however_late(spark, tmp_path):
    """Rows in are facts, rejected and repeated rows; events 1 to 15 minutes late are facts like others."""
    rnd = random.Random(9)
    feed, sent, at = Feed(spark, tmp_path, "security_event"), 0, 0
    ids, known = [], {}
    for batch in range(5):
        out = []
        for _ in range(30):
            at += 60
            ids.append(len(ids))
            late = rnd.randrange(60, 901) if rnd.random() < 0.2 else 0
            known[ids[-1]] = event(ids[-1], at - late)
            out.append(known[ids[-1]])
        out += [known[i] for i in rnd.sample(ids, 4)]  # delivered again, now or batches later
        out += [event(10_000 + batch, at, kind="unheard_of"), {**event("x", at), "event_id": None}, {**event("x", at), "event_id": None}]
        sent += len(out)
        feed.add(out)
    sink = BatchTable(str(tmp_path / "facts"))
    finish(jobs.start_fact_stream(feed.stream(), "security_event", sink, str(tmp_path / "c")))
    counts = {r["verdict"]: r["row_count"] for r in jobs.accounting(sink.read(spark)).collect()}
    assert counts[jobs.VALID] == len(ids) and counts[jobs.REJECTED] == 15 and sum(counts.values()) == sent
    assert sorted(int(r["event_id"]) for r in jobs.facts(sink.read(spark)).collect()) == ids
