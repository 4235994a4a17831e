"""Versioned tables, and views, histories and dimensions kept up from change batches."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetscope.operators import asof, dims
from fleetscope.plans import health, trends, upkeep
from fleetscope.sources.sinks import BatchLog
from fleetscope.sources.versions import Conflict, VersionedTable, bucket
from fleetscope.streaming import jobs

T0 = datetime(2024, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- versions --------------------------------------------------------------------------------------


def test_readers_keep_their_version(spark, tmp_path):
    table, schema = VersionedTable(str(tmp_path / "t")), "id bigint"
    part = (F.col("id") % 3).cast("string")
    first = table.commit(spark, table.version(spark), table.stage(spark.range(9), part), 0)
    old = table.read(spark, schema, list(first.parts), first)
    second = table.commit(spark, first, table.stage(spark.range(100, 102).filter("id % 3 = 1"), part), 1)
    assert [second.parts[p] == first.parts[p] for p in "012"] == [True, False, True]  # untouched parts keep their files
    third = table.commit(spark, second, {"2": None})
    assert table.version(spark) == third and third.batch == 1 and sorted(third.parts) == ["0", "1"]
    assert rows_of(old) == [(i,) for i in range(9)]  # begun before, read after
    assert rows_of(table.read(spark, schema, list(third.parts), third)) == [(0,), (100,), (3,), (6,)]
    assert rows_of(table.read(spark, schema, ["2", "no such part"], third)) == []
    assert table.vacuum(spark, keep=2) == 1  # only part 1 of the first version is named by no other
    assert rows_of(table.read(spark, schema, list(second.parts), second)) == [(0,), (100,), (2,), (3,), (5,), (6,), (8,)]
    assert table.vacuum(spark, keep=1) == 1 and table.version(spark) == third


def test_two_writers_do_not_lose_each_other(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"))
    base = table.version(spark)
    table.commit(spark, base, {"a": "x"})
    with pytest.raises(Conflict):
        table.commit(spark, base, {"b": "y"})
    assert table.version(spark).parts == {"a": "x"}


def test_many_batches_leave_few_folders(spark, tmp_path):
    log = BatchLog(str(tmp_path / "log"), fan=3, keep=6)
    for n in range(29):
        log.write(spark.range(n, n + 1, 1, 1), n)
        if n == 16:
            reader = log.read(spark)
        if n == 17:
            assert rows_of(reader.select("id")) == sorted(((i,) for i in range(17)), key=repr)  # while parts were merged
    log.write(spark.range(100, 101, 1, 1), 28)  # run again: it replaces itself
    log.write(spark.range(100, 101, 1, 1), 5)  # merged long ago: left out
    assert sorted(r["id"] for r in log.read(spark).collect()) == [*range(28), 100]
    version = VersionedTable(log.path).version(spark)
    assert len(version.parts) <= 8 and len(os.listdir(tmp_path / "log" / "versions")) < 30
    assert {r["batch_id"] for r in log.earlier(spark, 9, "id bigint, batch_id int").collect()} == set(range(9))


def test_facts_into_a_log_of_batches(spark, tmp_path):
    schema = "event_id string, lock_id string, event_type string, severity string, event_time timestamp"
    source = str(tmp_path / "in")
    log = BatchLog(str(tmp_path / "facts"), fan=2)
    for n in range(5):
        ids = [n, n + 1]  # each event but the first and last comes twice
        rows = [(str(i), "a", "battery_low", "low", at(100_000 * i)) for i in ids]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.start_fact_stream(stream, "security_event", log, str(tmp_path / "c")).awaitTermination()
    counts = {r["verdict"]: r["row_count"] for r in jobs.accounting(log.read(spark)).collect()}
    assert counts == {jobs.VALID: 6, jobs.REPEATED: 4}
    assert len(VersionedTable(log.path).version(spark).parts) <= 3


# ---- views -----------------------------------------------------------------------------------------


def some_facts(spark, seed, n=160):
    rnd = random.Random(seed)
    lock = lambda: rnd.choice(["hot"] * 4 + ["a", "b", "c"])
    events = [(str(i), lock(), rnd.choice(["tamper_detected", "battery_low"]), rnd.choice(["critical", "high", "medium", "low"]), at(rnd.randrange(200_000))) for i in range(n)]
    moves = [(i, lock(), 1.0, 2.0, at(rnd.randrange(200_000))) for i in range(n // 3)]
    changes = [(i, lock(), rnd.choice(["active", "offline"]), rnd.choice([None, "S1", "S2", "S3"]), at(rnd.randrange(200_000))) for i in range(n // 4)]
    return (
        spark.createDataFrame(changes, "id long, lock_id string, status string, shipment_id string, change_time timestamp"),
        spark.createDataFrame(events, "id string, lock_id string, event_type string, severity string, event_time timestamp"),
        spark.createDataFrame(moves, "id long, lock_id string, latitude double, longitude double, update_time timestamp"),
    )


def dealt(df, n, i):
    return df.filter(F.pmod(F.xxhash64("id"), F.lit(n)) == i)


def test_health_after_each_batch_equals_a_rebuild(spark, tmp_path):
    facts = some_facts(spark, 3)
    ships = spark.createDataFrame([(f"S{i}", "stop", True) for i in (1, 2, 4)], "shipment_id string, status string, is_current boolean")
    view = upkeep.ShipmentHealth(VersionedTable(str(tmp_path / "v")), buckets=3)
    n = 3
    for i in range(n):
        view.apply(*(dealt(f, n, i) for f in facts), i)
        so_far = [f.filter(F.pmod(F.xxhash64("id"), F.lit(n)) <= i) for f in facts]
        assert rows_of(view.read(ships)) == rows_of(health.shipment_health(ships, *so_far)), i
    done = view.table.version(spark)
    assert view.apply(*(dealt(f, n, 1) for f in facts), 1) == done  # taken again, left out
    nothing = view.apply(*(f.limit(0) for f in facts), n)
    assert nothing.parts == done.parts and nothing.batch == n


def test_hourly_counts_touch_only_their_days(spark, tmp_path):
    _, events, _ = some_facts(spark, 4)
    view = upkeep.HourlyCounts(VersionedTable(str(tmp_path / "v")))
    first = view.apply(events, 0)
    late = spark.createDataFrame([("x", "a", "battery_low", "low", at(90_000))], events.schema)
    second = view.apply(late, 1)
    assert {p for p in second.parts if second.parts[p] != first.parts.get(p)} == {"20240102"}
    assert rows_of(view.read(spark)) == rows_of(trends.hourly_counts(events.unionByName(late)))
    assert rows_of(view.read(spark, first)) == rows_of(trends.hourly_counts(events))


# ---- history and merges ----------------------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_history_for_any_order_of_arrival(spark, tmp_path, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice("aaabc"), rnd.choice(["x", "y"]), at(rnd.randrange(0, 60)), i) for i in range(120)]
    schema = "lock_id string, status string, change_time timestamp, id bigint"
    history = upkeep.History(VersionedTable(str(tmp_path / "h")), "lock_id", ("status",), "change_time", "id", schema, buckets=4)
    rnd.shuffle(rows)
    for n in range(4):
        history.apply(spark.createDataFrame(rows[n * 30 : n * 30 + 30], schema), n)
    want = dims.scd2(spark.createDataFrame(rows, schema), "lock_id", ["status"], "change_time", "id")
    assert rows_of(history.read(spark)) == rows_of(want)
    only = history.read(spark, keys=spark.createDataFrame([("b",)], "lock_id string"))
    assert rows_of(only) == rows_of(want.filter("lock_id = 'b'"))


def test_a_late_change_between_two_equal_states(spark, tmp_path):
    schema = "lock_id string, status string, change_time timestamp, id bigint"
    history = upkeep.History(VersionedTable(str(tmp_path / "h")), "lock_id", ("status",), "change_time", "id", schema)
    history.apply(spark.createDataFrame([("a", "on", at(0), 1), ("a", "on", at(20), 2)], schema), 0)
    assert history.read(spark).count() == 1
    history.apply(spark.createDataFrame([("a", "off", at(10), 3)], schema), 1)
    got = [(r["status"], r["effective_from"], r["is_current"]) for r in history.read(spark).orderBy("effective_from").collect()]
    assert got == [("on", at(0), False), ("off", at(10), False), ("on", at(20), True)]


def test_merge_rewrites_only_touched_buckets(spark, tmp_path):
    schema, n = "id string, status string", 8
    dimension = upkeep.Dimension(VersionedTable(str(tmp_path / "d")), "id", schema, n)
    existing = spark.range(50).select(F.col("id").cast("string"), F.lit("old").alias("status"))
    first = dimension.merge(existing)
    staged = spark.createDataFrame([("7", "new"), ("new key", "new")], schema)
    second = dimension.merge(staged)
    changed = {p for p in second.parts if second.parts[p] != first.parts.get(p)}
    assert changed == {r[0] for r in staged.select(bucket("id", n)).collect()}
    assert rows_of(dimension.read(spark)) == rows_of(dims.merge_dimension(existing, staged, "id"))


# ---- cells of interval joins -----------------------------------------------------------------------


def test_cells_cover_each_unit_once(spark):
    rnd = random.Random(5)
    pairs = [(0, 0), (-9, -9), (7, 8), (-1, 0), (0, 8**8), (-(8**8), 8**8 + 5)]
    for _ in range(300):
        low = rnd.randrange(-600, 600)
        pairs.append((low, low + rnd.choice([0, 1, 7, 8, 63, 64, 511, 600])))
    df = spark.createDataFrame(pairs, "a long, b long")
    for r in df.select("a", "b", asof._cells(F.col("a"), F.col("b")).alias("cells")).collect():
        spans = sorted((c["number"] * 8 ** c["level"], (c["number"] + 1) * 8 ** c["level"]) for c in r["cells"])
        assert spans[0][0] == r["a"] and spans[-1][1] == r["b"] + 1
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
        assert len(spans) <= 14 * 9


def test_intervals_of_years_stay_few_rows(spark):
    years = spark.createDataFrame([("a", at(0), at(10 * 365 * 86_400), "s"), ("a", at(5), None, "open")], "k string, x timestamp, y timestamp, s string")
    points = spark.createDataFrame([(i, "a", at(i * 86_400 * 30)) for i in range(122)], "id long, k string, t timestamp")
    found = asof.interval_join(points, years, "k", "t", "x", "y", ["s"], "inner")
    want = {(i, s) for i in range(122) for s, low, high in (("s", 0, 10 * 365), ("open", 1e-4, 1e9)) if low <= i * 30 < high}
    assert {(r["id"], r["s"]) for r in found.collect()} == want
    hours = 10 * 365 * 24
    first = points.limit(1).select(asof._cells(F.lit(0).cast("long"), F.lit(hours).cast("long")).alias("c")).first()["c"]
    assert len(first) <= 60  # instead of 3,650 days
