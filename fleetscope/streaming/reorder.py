"""Rows of a stream put in order: held in state until the watermark has passed them.

Rows are keyed by time slice and lane. A slice's rows wait in state and go on together, when the watermark
has passed the end of the slice; then the state is gone. So all rows that go on in one micro-batch are
older than those of any later one, however they were shuffled on their way in, and what follows may compare
each row with the one before it of the same device. Rows of a slice that has gone on already come out
marked late. Lanes are dealt by a hash of the whole row, so that a device with very many rows is not one
task's work, and state holds no more than the rows of the watermark's delay and one slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

LATE = "late"
_SLICE, _LANE, _AT = "_slice", "_lane", "_at"


def plain_rows(part: pd.DataFrame) -> list[tuple]:
    """Rows as tuples of Python values, missing ones as None."""
    return list(zip(*(part[c].astype(object).where(part[c].notna(), None).tolist() for c in part.columns)))


class HoldSlice(StatefulProcessor):
    """State of one lane of a slice: its rows, until the timer at the end of the slice."""

    def __init__(self, columns: StructType, slice_ms: int):
        self.columns, self.slice_ms = columns, slice_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.columns)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        end = (int(key[0]) + 1) * self.slice_ms
        gone = timerValues.getCurrentWatermarkInMs() > end
        for part in rows:
            part = part[self.columns.names]
            if gone:
                yield part.assign(**{LATE: True})
            else:
                self.rows.appendList(plain_rows(part))
        if not gone:
            self.handle.registerTimer(end)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame(list(self.rows.get()), columns=self.columns.names)
        self.rows.clear()
        yield held.assign(**{LATE: False})

    def close(self) -> None:
        pass


@dataclass(frozen=True)
class Ordering:
    """How late a row may be, how long a slice is, and how many ways the rows of a slice are dealt.

    Each slice and lane that has rows costs some milliseconds: a stream with few rows wants longer slices.
    """

    delay: str = "5 minutes"
    slice_seconds: int = 60
    lanes: int = 64


def in_order(stream: DataFrame, ts: str, how: Ordering) -> DataFrame:
    """The stream's rows with ``late``: rows that are not late come in the order of their slices.

    ``ts`` is a timestamp; rows without one cannot be ordered and come out as late.
    """
    fields = [StructField(f.name, LongType()) if f.name == ts else f for f in stream.schema.fields]
    columns = StructType(fields)
    micros = F.unix_micros(ts)
    keys = {
        _SLICE: F.coalesce(F.floor(micros / (how.slice_seconds * 1_000_000)), F.lit(-1)),
        _LANE: F.pmod(F.xxhash64(*stream.columns), F.lit(how.lanes)),
        _AT: micros,
    }
    # the watermark hangs on a column that is dropped: rows behind it are to come out, not to be lost
    packed = stream.withWatermark(ts, how.delay).withColumns(keys).drop(ts).withColumnRenamed(_AT, ts)
    held = packed.select(*columns.names, _SLICE, _LANE).groupBy(_SLICE, _LANE).transformWithStateInPandas(
        statefulProcessor=HoldSlice(columns, how.slice_seconds * 1000),
        outputStructType=StructType([*fields, StructField(LATE, BooleanType())]),
        outputMode="append",
        timeMode="eventTime",
    )
    return held.withColumn(ts, F.timestamp_micros(ts)).select(*stream.columns, LATE)
