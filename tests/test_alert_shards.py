"""Alert state of many devices in one shard: the same transitions, and no call per device."""

import random
from collections import Counter
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql.types import StringType, StructField
from test_ordered_streams import Lots, at, rows_of, run_alert

from fleetscope.streaming import conditions
from fleetscope.streaming.conditions import LATE, Condition, Follow, Tracker

MS = 1000


class Held:
    """A state variable that counts how often it is called."""

    def __init__(self, calls, empty):
        self.calls, self.empty, self.value = calls, empty, empty

    def get(self):
        self.calls["get"] += 1
        return self.value

    def update(self, value):
        self.calls["update"] += 1
        self.value = value

    put = update

    def appendList(self, rows):
        self.calls["append"] += 1
        self.value = [*self.value, *rows]

    def clear(self):
        self.calls["clear"] += 1
        self.value = self.empty


class Handle:
    def __init__(self):
        self.calls, self.timers = Counter(), set()

    def getListState(self, name, schema):
        return Held(self.calls, [])

    def getValueState(self, name, schema):
        return Held(self.calls, None)

    def registerTimer(self, ms):
        self.calls["register"] += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.calls["delete"] += 1
        self.timers.remove(ms)


def followed(rule, rows, devices):
    """Transitions and calls when the rows of a shard come in two lots, each followed by the clock."""
    handle, out = Handle(), []
    follow = Follow(rule, StructField("lock_id", StringType()))
    follow.init(handle)
    for lot, watermark in enumerate((0, 200, 5000)):
        clock = SimpleNamespace(getCurrentWatermarkInMs=lambda watermark=watermark: watermark)
        if lot < 2:
            own = [r for r in rows if (r[1] >= 250 * MS) == bool(lot)]
            part = pd.DataFrame(own, columns=["lock_id", "at", "tie", "opens"])
            out += follow.handleInputRows((7,), iter([part]), clock)
        for timer in [t for t in handle.timers if t < watermark]:
            handle.timers.discard(timer)
            out += follow.handleExpiredTimer((7,), clock, None)
    assert not follow.waiting.value
    return sorted(tuple(r) for part in out for r in part.itertuples(index=False)), handle.calls


@pytest.mark.parametrize("rule", [Condition("held", "", hold=50 * MS), Condition("lag", "", lag=30 * MS), Condition("tick", "", hold=90 * MS, tick=60 * MS)])
def test_a_shard_is_its_devices_and_takes_no_call_for_each(rule):
    rnd, calls = random.Random(4), {}
    for devices in (10, 400):
        rows = [
            (f"l{d}", t * MS, t, int(rnd.random() < 0.7))
            for d in range(devices)
            for t in rnd.sample(range(1, 500), rnd.randint(1, 6))
        ]
        rnd.shuffle(rows)
        want = []
        for d in range(devices):
            tracker = Tracker(rule)
            for _, a, _, opens in sorted(r for r in rows if r[0] == f"l{d}"):
                tracker.row(a, bool(opens))
            tracker.advance(4999 * MS // rule.tick * rule.tick)
            want += [(f"l{d}", *told) for told in tracker.out]
        found, calls[devices] = followed(rule, rows, devices)
        assert found == sorted(want)
    assert sum(calls[400].values()) <= sum(calls[10].values()) + 4


def test_late_rows_of_a_shard_are_told_by_device():
    follow = Follow(Condition("held", "", hold=MS), StructField("lock_id", StringType()))
    follow.init(Handle())
    part = pd.DataFrame([("a", 5 * MS, 1, 1), ("b", 900 * MS, 2, 1)], columns=["lock_id", "at", "tie", "opens"])
    clock = SimpleNamespace(getCurrentWatermarkInMs=lambda: 100)
    told = [tuple(r) for frame in follow.handleInputRows((0,), iter([part]), clock) for r in frame.itertuples(index=False)]
    assert told == [("a", LATE, 5 * MS, 5 * MS, 1)]


def test_numbered_devices_beside_rows_without_one(spark, tmp_path):
    feed = Lots(spark, tmp_path / "in", "id long, lock_id long, status string, change_time timestamp", "change_time")
    big = 2**60 + 1
    feed.add([(1, big, "offline", at(60)), (2, None, "offline", at(60)), (3, big + 2, "active", at(61)), (4, 7, "offline", at(62))])
    feed.clock(10**6)
    on = conditions.periods(run_alert(spark, tmp_path, feed, conditions.LONG_OFFLINE), "lock_id")
    assert rows_of(on.drop("n")) == [(big, at(60), at(1860), None), (7, at(62), at(1862), None)]
