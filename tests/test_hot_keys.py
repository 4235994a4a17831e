"""Operators on data where one lock holds most rows, against plain Python or the unsplit plan."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetscope.operators import changelog, hot
from fleetscope.operators.asof import asof_join, interval_join, interval_totals, salted_join
from fleetscope.operators.ordered import over_history, rolling_count, running, sessions
from fleetscope.plans import sequences

T0 = datetime(2024, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


@pytest.fixture(scope="module")
def skewed(spark):
    """600 events, a third and more on one lock, with repeated times and one crowded second."""
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        lock = "hot" if rnd.random() < 0.6 else f"l{rnd.randrange(30)}"
        second = 5000 if i % 10 == 0 else rnd.randrange(0, 20_000, 50)
        severity = rnd.choice(["low", "medium", "high", "critical"])
        rows.append((f"{i:04d}", lock, rnd.choice(["tamper_detected", "unlock_attempt"]), severity, at(second)))
    schema = "id string, lock_id string, event_type string, severity string, event_time timestamp"
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def splitting(spark):
    spark.conf.set(hot.MIN_ROWS, "10")
    spark.conf.set(hot.MAX_SPLITS, "64")
    yield
    spark.conf.unset(hot.MIN_ROWS)
    spark.conf.unset(hot.MAX_SPLITS)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_no_split_below_floor(spark, skewed):
    assert hot.hot_segments(skewed, "lock_id", "event_time") is None


def test_segments_are_ordered_and_balanced(spark, skewed, splitting):
    found = hot.hot_segments(skewed, "lock_id", "event_time")
    assert "hot" in {r["lock_id"] for r in found.table.collect()}
    every = hot.with_segment(skewed, "event_time", found)
    assert every.count() == 600
    cut = hot.with_segment(skewed, "event_time", found, only_hot=True)
    assert rows(cut) == rows(every.filter(F.col(hot.SEG) > 0))
    spans = cut.filter("lock_id = 'hot'").groupBy(hot.SEG)
    spans = spans.agg(F.min("event_time"), F.max("event_time"), F.count("*")).orderBy(hot.SEG).collect()
    assert len(spans) > 10
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))
    # one second holds many rows and cannot be cut; the others stay near the target
    assert sorted(r[3] for r in spans)[-2] < 40


def test_segments_from_a_sample(spark, skewed, splitting, monkeypatch):
    monkeypatch.setattr(hot, "SAMPLED_PER_SPLIT", 5)
    found = hot.hot_segments(skewed, "lock_id", "event_time")
    every = hot.with_segment(skewed, "event_time", found)
    assert every.count() == 600 and every.filter(f"lock_id = 'hot' and {hot.SEG} = 0").count() == 0
    split = rows(sequences.event_windows(skewed))
    spark.conf.set(hot.MIN_ROWS, "1000000")
    assert split == rows(sequences.event_windows(skewed))


@pytest.mark.parametrize("kind", ["one open all along", "always the other", "chain"])
def test_assignments_that_hang_on_the_first_message(spark, splitting, kind):
    """The start of every segment depends on the very first message, however many segments there are."""
    n = 400
    if kind == "one open all along":  # nothing takes effect while the first is open, and it closes at the end
        ops = [("assigned", "A")] + [(("assigned", "released")[i % 2], f"S{i % 7}") for i in range(n - 2)] + [("released", "A")]
    elif kind == "always the other":  # which of two shipments is open flips with the first message
        ops = [("assigned", "A")] + [x for _ in range(n // 4) for x in (("released", "A"), ("assigned", "B"), ("released", "B"), ("assigned", "A"))]
    else:  # each release opens the way for the next shipment
        ops = [x for i in range(n // 2) for x in (("assigned", f"S{i}"), ("released", f"S{i - 40}"))]
    log = [("hot", a, s, at(10 * i), i) for i, (a, s) in enumerate(ops)]
    df = spark.createDataFrame(log, "lock_id string, action string, shipment_id string, change_time timestamp, seq int")
    known = df.select("shipment_id").distinct()
    got = changelog.assignments_from_log(df, known, ["change_time", "seq"])
    assert rows(got) == sorted([("hot", *o) for o in _machine([(t, i, a, s) for _, a, s, t, i in log])], key=repr)
    opened = changelog.accepted_operations(
        df.filter("seq >= 3"), known, ["change_time", "seq"], spark.createDataFrame([("hot", ops[0][1])], "lock_id string, shipment_id string")
    )
    state, want = ops[0][1], []
    for i, (action, ship) in list(enumerate(ops))[3:]:
        takes = state is None if action == "assigned" else state == ship
        if takes:
            state = ship if action == "assigned" else None
            want.append(i)
    assert sorted(r["seq"] for r in opened.collect()) == want


@pytest.mark.parametrize(
    "build",
    [
        sequences.event_windows,
        sequences.time_between_events,
        sequences.event_sequences,
        sequences.sliding,
        lambda e: sequences.sliding(e, 5),
        sequences.running_totals,
        sequences.events_last_hour,
    ],
)
def test_split_equals_whole(build, spark, skewed, splitting):
    split = rows(build(skewed))
    spark.conf.set(hot.MIN_ROWS, "1000000")
    assert split == rows(build(skewed))


def test_running_total_ends_at_group_count(skewed, splitting):
    last = sequences.running_totals(skewed).groupBy("lock_id").agg(F.max("running_total").alias("n"))
    assert rows(last) == rows(skewed.groupBy("lock_id").count())


def test_deep_lookback_crosses_short_segments(spark, skewed, splitting):
    def build(w):
        return {"far": F.lag("id", 25).over(w), "next": F.lead("id", 13).over(w), "n": running("_one", w)}

    order = ["event_time", "id"]
    split = over_history(skewed, "lock_id", order, build, 25, 13, {"_one": F.lit(1)})
    split = rows(split)
    spark.conf.set(hot.MIN_ROWS, "1000000")
    assert split == rows(over_history(skewed, "lock_id", order, build, 25, 13, {"_one": F.lit(1)}))


def test_rolling_count_brute_force(spark, skewed, splitting):
    timed = skewed.select("lock_id", "id", F.unix_timestamp("event_time").alias("sec"))
    got = {r["id"]: r["n"] for r in rolling_count(timed, "lock_id", "sec", 600, "n").collect()}
    data = timed.collect()
    for r in data:
        want = sum(1 for o in data if o["lock_id"] == r["lock_id"] and r["sec"] - 600 <= o["sec"] <= r["sec"])
        assert got[r["id"]] == want


def test_asof_brute_force(spark, skewed, splitting):
    marks = skewed.filter("severity = 'low'").select("lock_id", F.col("event_time").alias("t"), "id", F.col("id").alias("v"))
    got = {r["id"]: r["v"] for r in asof_join(skewed, marks, "lock_id", "event_time", "t", ["v"], "id").collect()}
    known = [(m["lock_id"], m["t"], m["id"]) for m in marks.collect()]
    assert len(got) == 600
    for e in skewed.collect():
        before = [(t, i) for lock, t, i in known if lock == e["lock_id"] and t <= e["event_time"]]
        assert got[e["id"]] == (max(before)[1] if before else None)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_interval_brute_force(spark, skewed, splitting, how):
    rnd = random.Random(9)
    spans = []
    for i in range(80):
        start = rnd.randrange(0, 200_000) - 50_000
        end = None if i % 9 == 0 else at(start + rnd.choice([0, 50, 3600, 90_000]))
        spans.append((f"s{i}", rnd.choice(["hot", "l1", "l2", "none"]), at(start), end))
    right = spark.createDataFrame(spans, "s string, lock_id string, a timestamp, b timestamp")
    got = interval_join(skewed, right, "lock_id", "event_time", "a", "b", ["s"], how)
    got = sorted(((r["id"], r["s"]) for r in got.collect()), key=repr)
    want = []
    for e in skewed.collect():
        hits = [
            s
            for s, lock, a, b in spans
            if lock == e["lock_id"] and a <= e["event_time"] and (b is None or e["event_time"] < b)
        ]
        want += [(e["id"], s) for s in hits] or ([(e["id"], None)] if how == "left" else [])
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("split", [True, False])
def test_interval_totals_equal_join(spark, skewed, splitting, split):
    if not split:
        spark.conf.set(hot.MIN_ROWS, "1000000")
    rnd = random.Random(2)
    spans = []
    for i in range(90):
        start = rnd.randrange(0, 20_000, 50)
        end = None if i % 9 == 0 else at(start + rnd.choice([-50, 0, 50, 3600, 9_000]))
        spans.append((i % 7, rnd.choice(["hot", "l1", "l2", "none"]), at(start), end))
    right = spark.createDataFrame(spans, "s int, lock_id string, a timestamp, b timestamp")
    points = skewed.withColumn("n", F.lit(1)).withColumn("c", (F.col("severity") == "critical").cast("int"))
    got = interval_totals(points, right, "lock_id", "event_time", "a", "b", ["n", "c"], ["s"])
    joined = interval_join(points, right, "lock_id", "event_time", "a", "b", ["s"], "inner")
    want = joined.groupBy("s").agg(F.sum("n"), F.sum("c"))
    assert rows(got.filter("n > 0")) == rows(want)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain(spark, skewed, splitting, how):
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("l3", 3), ("l99", 4)], "lock_id string, v int")
    salted, plain = salted_join(skewed, right, "lock_id", how), skewed.join(right, "lock_id", how)
    assert rows(salted.select(*plain.columns)) == rows(plain)


@pytest.mark.parametrize("gap", ["7 seconds", "1 minute", "1 day"])
def test_sessions_equal_session_windows(spark, skewed, splitting, gap):
    measures = lambda: {"n": F.count("*"), "ids": F.sort_array(F.collect_list("id"))}
    got = sessions(skewed, "lock_id", ["event_time", "id"], gap, measures())
    w = F.session_window("event_time", gap).alias("w")
    want = skewed.groupBy("lock_id", w).agg(*[c.alias(n) for n, c in measures().items()])
    assert rows(got) == rows(want.select("lock_id", "w.start", "w.end", "n", "ids"))


def _machine(ops):
    """Assignments of one lock by the plain state machine."""
    out, active = [], None
    for at_, _, action, shipment in sorted(ops):
        if action == "assigned" and active is None:
            active = len(out)
            out.append([shipment, at_, None])
        elif action == "released" and active is not None and out[active][0] == shipment:
            out[active][2] = at_
            active = None
    return [tuple(o) for o in out]


@pytest.mark.parametrize("seed,shipments", [(1, 2), (2, 5), (3, 40)])
def test_assignments_brute_force(spark, splitting, seed, shipments):
    rnd = random.Random(seed)
    log = []
    for i in range(500):
        lock = "hot" if rnd.random() < 0.7 else f"l{rnd.randrange(8)}"
        action = rnd.choice(["assigned", "released", "status_changed"])
        ship = rnd.choice([None] + [f"S{n}" for n in range(shipments + 1)])
        log.append((lock, action, ship, at(rnd.randrange(0, 4000)), i))
    df = spark.createDataFrame(log, "lock_id string, action string, shipment_id string, change_time timestamp, seq int")
    known = spark.createDataFrame([(f"S{n}",) for n in range(shipments)], "shipment_id string")
    got = changelog.assignments_from_log(df, known, ["change_time", "seq"])
    want = []
    for lock in {r[0] for r in log}:
        ops = [(t, i, a, s) for k, a, s, t, i in log if k == lock and s and s != f"S{shipments}"]
        want += [(lock, *o) for o in _machine(ops)]
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize(
    "build",
    [
        sequences.event_windows,
        sequences.running_totals,
        sequences.time_between_events,
        sequences.event_sequences,
        sequences.attack_pattern,
        sequences.sliding,
    ],
)
def test_null_times_come_out_the_same_when_split(spark, skewed, splitting, build):
    unknown = F.when(F.col("id").cast("int") % 50 != 7, F.col("event_time"))
    events = skewed.withColumn("event_time", unknown)
    assert events.filter("event_time is null and lock_id = 'hot'").count() > 2
    split = rows(build(events))
    spark.conf.set(hot.MIN_ROWS, "1000000")
    assert split == rows(build(events))


def test_open_ends_do_not_stretch_the_buckets(spark, skewed, splitting):
    forever = F.lit("9999-12-31 00:00:00").cast("timestamp")
    ends = skewed.withColumn("event_time", F.when(F.col("id").cast("int") % 3 == 0, forever).otherwise(F.col("event_time")))
    found = hot.hot_segments(ends, "lock_id", "event_time")
    per_bucket = found.lookup.groupBy("lock_id", hot._BUCKET).count()
    assert per_bucket.agg(F.max("count")).first()[0] <= 4
    every = hot.with_segment(ends, "event_time", found)
    assert every.count() == 600 and every.filter(f"lock_id = 'hot' and {hot.SEG} = 0").count() == 0
