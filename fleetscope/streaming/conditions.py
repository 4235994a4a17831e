"""Alerts as streams: when a condition begins to hold for a device, and when it ends, also by silence.

A row either opens a condition or closes it. It holds from ``lag`` after a row that opens it until ``hold``
after the last such row, or until a row that closes it. Both ends by the clock are event-time timers, so they
come when the watermark gets there, whether or not the device sends anything more. Rows are put in order by
time within state before they count; rows that come after the watermark has passed them are counted as late.

Alerts on a share of all devices add up the devices' transitions per tick of a coarse clock: every transition
of a tick comes out in the same micro-batch, so that running totals over the few ticks of a batch are enough.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegralType, LongType, StringType, StructField, StructType

from fleetscope.sources.sinks import BatchTable
from fleetscope.streaming.reorder import plain_rows

RAISED, WITHDRAWN, LATE = "raised", "withdrawn", "late"
SECOND = 1_000_000
MINUTE, DAY = 60 * SECOND, 86_400 * SECOND


@dataclass(frozen=True)
class Condition:
    """Times in microseconds. ``opens`` is SQL over the stream's columns; rows for which it is not true close.

    ``hold`` None: it holds until a row closes it. ``tick``: transitions are moved up to whole ticks.
    """

    name: str
    opens: str
    lag: int = 0
    hold: int | None = None
    tick: int = 1


# ---- fixed values: conditions of the alert rules -----------------------------------------------------
TAMPER = Condition("tamper", "event_type = 'tamper_detected'", hold=MINUTE)
LONG_OFFLINE = Condition("long_offline", "status = 'offline'", lag=30 * MINUTE)
MASS_OFFLINE = Condition("mass_offline", "status = 'offline'", hold=5 * MINUTE, tick=MINUTE)
BATTERY = Condition("battery", "event_type = 'battery_low'", hold=DAY, tick=MINUTE)

#: Into how many shards devices are dealt; a checkpoint keeps the number it was begun with.
SHARDS = 1024
_SHARD, _NO_DEVICE = "_shard", -1  # rows without a device only move the clock

Transition = tuple[str, int, int, int]  # what, at, since, rows that opened it so far


class Tracker:
    """The condition of one device as a function of its rows in order and of the clock."""

    FIELDS = ("since", "start", "until", "raised", "n")

    def __init__(self, rule: Condition, state: tuple | None = None):
        self.rule, self.out = rule, []
        self.since, self.start, self.until, self.raised, self.n = state or (None, None, None, None, 0)

    def state(self) -> tuple:
        return self.since, self.start, self.until, self.raised, self.n

    def due(self) -> int | None:
        """When the clock changes something next."""
        return self.start if self.start is not None else self.until if self.raised is not None else None

    def tell(self, what: str, at: int) -> None:
        tick = self.rule.tick
        self.out.append((what, -(-at // tick) * tick, self.since, self.n))

    def advance(self, to: int) -> None:
        """The clock has passed ``to``."""
        if self.start is not None and self.start <= to:
            self.raised, self.start = self.start, None
            self.tell(RAISED, self.raised)
        if self.raised is not None and self.until is not None and self.until <= to:
            self._withdraw(self.until)

    def _withdraw(self, at: int) -> None:
        self.tell(WITHDRAWN, at)
        self.raised = self.until = None
        self.n = 0

    def row(self, at: int, opens: bool) -> None:
        """The next row; a condition that would end at its very time goes on if it opens it again."""
        rule = self.rule
        self.advance(at - 1)
        if opens and not rule.lag:
            self.n += 1
            self.until = None if rule.hold is None else at + rule.hold
            if self.raised is None:
                self.since = self.raised = at
                self.tell(RAISED, at)
            return
        if self.raised is not None:
            self._withdraw(at)
        self.start = None
        if opens:
            self.since, self.start, self.n = at, at + rule.lag, 1
            self.until = None if rule.hold is None else at + rule.hold


_ROW = [StructField("at", LongType()), StructField("tie", LongType()), StructField("opens", LongType())]
_OUT = [StructField("what", StringType()), StructField("at", LongType()), StructField("since", LongType()), StructField("n", LongType())]


class Follow(StatefulProcessor):
    """State of a shard of devices: rows that the watermark has not passed, where conditions hold, and one timer."""

    def __init__(self, rule: Condition, key: StructField):
        self.rule, self.key = rule, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", StructType([self.key, *_ROW]))
        self.stands = handle.getListState("stands", StructType([self.key, *[StructField(n, LongType()) for n in Tracker.FIELDS]]))
        self.timer = handle.getValueState("timer", StructType([StructField("at", LongType())]))

    def _passed(self, timer_values) -> int:
        """Microseconds that lie behind the watermark, whole ticks of them."""
        micros = (timer_values.getCurrentWatermarkInMs() - 1) * 1000
        return micros // self.rule.tick * self.rule.tick

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        to = self._passed(timerValues)
        if key[0] == _NO_DEVICE:
            return
        new = [r for part in rows for r in self._rows(part)]
        late = [r for r in new if r[1] <= to]
        if late:
            yield self._frame([(r[0], LATE, r[1], r[1], 1) for r in late])
        new = [r for r in new if r[1] > to]
        if new:
            self.waiting.appendList(new)
            self._remind(min(r[1] for r in new))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        to = self._passed(timerValues)
        passed, ahead, found = {}, [], []
        for device, *row in self.waiting.get():
            passed.setdefault(device, []).append(tuple(row)) if row[0] <= to else ahead.append((device, *row))
        stood = {device: tuple(state) for device, *state in self.stands.get()}
        stands, due = {}, [at for _, at, *_ in ahead]
        for device in stood.keys() | passed.keys():
            tracker = Tracker(self.rule, stood.get(device))
            for at, _, opens in sorted(passed.get(device, ())):
                tracker.row(at, bool(opens))
            tracker.advance(to)
            found += [(device, *told) for told in tracker.out]
            if tracker.start is not None or tracker.raised is not None:  # nothing is left of a device that is well
                stands[device] = tracker.state()
                due.append(tracker.due())
        if passed:
            self.waiting.put(ahead) if ahead else self.waiting.clear()
        if stands != stood:
            self.stands.put([(device, *state) for device, state in stands.items()]) if stands else self.stands.clear()
        self.timer.clear()
        due = [at for at in due if at is not None]
        if due:
            self._remind(min(due))
        if found:
            yield self._frame(found)

    def _remind(self, at: int) -> None:
        """See that the timer goes off as soon as the watermark has passed the tick of ``at``."""
        tick = self.rule.tick
        wanted = (-(-at // tick) * tick + 999) // 1000  # a timer goes off once the watermark is greater
        timer = self.timer.get()
        if timer is None or wanted < timer[0]:
            if timer is not None:
                self.handle.deleteTimer(timer[0])
            self.handle.registerTimer(wanted)
            self.timer.update((wanted,))

    def _rows(self, part: pd.DataFrame) -> list[tuple]:
        """Device, at, tie and opens; whole-number devices stay whole where pandas made them floats."""
        own = plain_rows(part[[self.key.name, "at", "tie", "opens"]])
        return [(int(r[0]), *r[1:]) for r in own] if isinstance(self.key.dataType, IntegralType) else own

    def _frame(self, found: list[tuple]) -> pd.DataFrame:
        """Transitions with their device in front."""
        return pd.DataFrame(found, columns=[self.key.name, *[f.name for f in _OUT]])

    def close(self) -> None:
        pass


def transitions(
    stream: DataFrame, rule: Condition, key: str, ts: str, tie: str, delay: str = "10 minutes", shards: int = SHARDS
) -> DataFrame:
    """Columns key, what (raised, withdrawn or late), at, since and n of every device's condition.

    Rows of equal time count in the order of ``tie``, a whole number or its text. A call of the stateful function
    costs some milliseconds whatever it works on, so devices are dealt into ``shards`` that share one call.
    """
    kind = StructField(key, stream.schema[key].dataType)
    at = F.unix_micros(ts)
    opens = F.coalesce(F.expr(rule.opens), F.lit(False)).cast("bigint")
    # the watermark hangs on a column that is dropped: rows behind it are to be counted, not to be lost
    rows = stream.withWatermark(ts, delay).select(key, at.alias("at"), F.col(tie).cast("bigint").alias("tie"), opens.alias("opens"))
    shard = F.pmod(F.xxhash64(key), F.lit(shards))
    rows = rows.withColumn(_SHARD, F.when(F.col(key).isNull(), F.lit(_NO_DEVICE)).otherwise(shard).cast("bigint"))
    followed = rows.groupBy(_SHARD).transformWithStateInPandas(
        statefulProcessor=Follow(rule, kind),
        outputStructType=StructType([kind, *_OUT]),
        outputMode="append",
        timeMode="eventTime",
    )
    times = {c: F.timestamp_micros(c) for c in ("at", "since")}
    return followed.withColumns(times)


def periods(table: DataFrame, key: str) -> DataFrame:
    """From a table of transitions, each time the alert was on: since, raised_at, withdrawn_at (null: still on), n."""
    at = lambda what: F.max(F.when(F.col("what") == what, F.col("at")))
    told = table.filter(F.col("what") != LATE)
    return told.groupBy(key, "since").agg(at(RAISED).alias("raised_at"), at(WITHDRAWN).alias("withdrawn_at"), F.max("n").alias("n"))


def share_flips(
    load_devices: Callable[[], DataFrame], limit: float, sink: BatchTable, state: BatchTable
) -> Callable[[DataFrame, int], None]:
    """A batch function over transitions: writes when the share of devices in the condition goes over ``limit``
    or back. The number of devices is read anew for each batch; the total is carried from batch to batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        step = F.when(F.col("what") == RAISED, 1).when(F.col("what") == WITHDRAWN, -1)
        ticks = batch.filter(step.isNotNull()).groupBy("at").agg(F.sum(step).alias("step"), F.lit(None).cast("boolean").alias("was"))
        if batch_id:
            before = state.read(spark, [batch_id - 1])
        else:
            before = spark.range(1, numPartitions=1).select(F.lit(0).cast("bigint").alias("total"), F.lit(False).alias("alert"))
        start = before.select(F.lit(None).cast("timestamp").alias("at"), F.col("total").alias("step"), F.col("alert").alias("was"))
        order = Window.orderBy(F.asc_nulls_first("at"))  # the ticks of one batch
        devices = load_devices().agg(F.count("*")).scalar()
        counted = start.unionByName(ticks).withColumns({"total": F.sum("step").over(order), "devices": devices})
        share = F.col("total") / F.nullif(F.col("devices"), F.lit(0))
        counted = counted.withColumns({"share": share, "alert": F.coalesce("was", share > limit, F.lit(False))})
        counted = counted.withColumn("_before", F.lag("alert").over(order)).persist()
        flips = counted.filter(F.col("at").isNotNull() & (F.col("alert") != F.col("_before")))
        what = F.when(F.col("alert"), RAISED).otherwise(WITHDRAWN)
        sink.write(flips.select("at", what.alias("what"), "total", "devices", F.round("share", 4).alias("share")), batch_id)
        last = F.max_by(F.struct("total", "alert"), F.struct(F.col("at").isNotNull(), "at")).alias("l")
        state.write(counted.agg(last).select("l.*"), batch_id)
        counted.unpersist()

    return write
