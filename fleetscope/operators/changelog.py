"""Folding change logs into current-state tables.

Every fold orders the log by ``order`` (event time, then arrival by default). All but the assignment
state machine are plain aggregates, which combine on the map side and so do not care how many
messages one device has sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from fleetscope.operators.asof import salted_join
from fleetscope.operators.hot import SEG, Segments, hot_segments, with_segment
from fleetscope.operators.ordered import DETECT, over_history
from fleetscope.session import checkpointed


def _fold_entity(log: DataFrame, key: str, ts: str, order: list[str]) -> DataFrame:
    """First creation wins; the last status change after it overwrites; earlier changes do not count."""
    place = F.struct(*order)
    row = F.struct(place.alias("at"), F.col("status"), F.col(ts).alias("last_update"))
    created = F.when(F.col("action") == "created", place)
    changed = F.when(F.col("action") == "status_changed", place)
    folded = (
        log.filter(F.col("action").isin("created", "status_changed"))
        .groupBy(key)
        .agg(F.min_by(row, created).alias("c"), F.max_by(row, changed).alias("s"))
        .filter(F.col("c").isNotNull())
    )
    use_change = F.col("s.at") > F.col("c.at")
    pick = lambda name: F.when(use_change, F.col(f"s.{name}")).otherwise(F.col(f"c.{name}")).alias(name)
    return folded.select(key, pick("status"), pick("last_update"))


def current_locks(status_log: DataFrame, order: list[str], ts: str = "change_time") -> DataFrame:
    return _fold_entity(status_log, "lock_id", ts, order).withColumnRenamed("lock_id", "id")


def current_shipments(shipment_log: DataFrame, order: list[str], ts: str = "change_time") -> DataFrame:
    return _fold_entity(shipment_log, "shipment_id", ts, order)


def current_locations(status_log: DataFrame, location_log: DataFrame, order: list[str], ts: str = "change_time") -> DataFrame:
    """Latest position per known lock, seeded from the first creation message if it has coordinates.

    ``order`` names columns of the status log; the location log carries the same columns, so both
    are folded in one aggregate. Updates of a lock that was never created, or not created yet, are
    rejected.
    """
    place = F.struct(*order)
    point = F.struct(place.alias("at"), F.col("latitude"), F.col("longitude"))
    cols = ["lock_id", "latitude", "longitude", *order]
    created = status_log.filter(F.col("action") == "created").select(*cols, F.lit(True).alias("is_creation"))
    updates = location_log.select(*cols, F.lit(False).alias("is_creation"))
    folded = (
        created.unionByName(updates)
        .groupBy("lock_id")
        .agg(
            F.min_by(point, F.when(F.col("is_creation"), place)).alias("c"),
            F.max_by(point, F.when(~F.col("is_creation"), place)).alias("u"),
        )
        .filter(F.col("c").isNotNull())
    )
    moved = F.col("u.at") > F.col("c.at")
    seeded = F.col("c.latitude").isNotNull() & F.col("c.longitude").isNotNull()
    pick = lambda name: F.when(moved, F.col(f"u.{name}")).otherwise(F.col(f"c.{name}")).alias(name)
    return folded.filter(moved | seeded).select("lock_id", pick("latitude"), pick("longitude"))


def with_previous_status(status_log: DataFrame, order: list[str]) -> DataFrame:
    """``previous_status`` as sent, or else the status of the lock's message before."""
    filled = over_history(
        status_log, "lock_id", order, lambda w: {"_before": F.lag("status").over(w)}, back=1
    )
    return filled.withColumn("previous_status", F.coalesce("previous_status", "_before")).drop("_before")


# ---- assignments: a state machine per lock -------------------------------------------------------

OPENS = "opens"
_START, _FROM, _TO = "_start", "_from", "_to"
_LANE = [StructField("lock_id", StringType()), StructField(SEG, IntegerType())]


def assignments_from_log(status_log: DataFrame, shipments: DataFrame, order: list[str]) -> DataFrame:
    """Assignment intervals from ``assigned`` and ``released`` messages; ``order`` starts with the time."""
    accepted, hot = _accepted(status_log, shipments, order, None)
    return pair_operations(accepted, order, hot)


def accepted_operations(
    status_log: DataFrame, shipments: DataFrame, order: list[str], opening: DataFrame | None = None
) -> DataFrame:
    """The assignment messages that take effect, with ``opens`` telling assigned from released.

    ``assigned`` opens an interval only while none is open; ``released`` closes the open one only if
    it names the same shipment; messages without or with an unknown shipment are skipped.
    ``opening`` (lock_id, shipment_id) names what is open before the first message.
    """
    return _accepted(status_log, shipments, order, opening)[0]


def _accepted(
    status_log: DataFrame, shipments: DataFrame, order: list[str], opening: DataFrame | None
) -> tuple[DataFrame, Segments | None]:
    ops = status_log.filter(F.col("action").isin("assigned", "released") & F.col("shipment_id").isNotNull())
    cols = ["lock_id", "shipment_id", *order, OPENS]
    ops = salted_join(
        ops.withColumn(OPENS, F.col("action") == "assigned").select(*cols),
        shipments.select("shipment_id").distinct(),
        "shipment_id",
        "left_semi",
    ).select(*cols)
    hot = hot_segments(ops, "lock_id", order[0])
    if hot is not None:
        ops = checkpointed(ops)  # read for the segments' functions and again from their starts
    lanes = with_segment(ops, order[0], hot).withColumn(_START, F.lit(None).cast("string"))
    if opening is not None:
        known = opening.select("lock_id", F.lit(0).alias(SEG), F.col("shipment_id").alias("_known"))
        lanes = lanes.join(known, ["lock_id", SEG], "left").withColumn(_START, F.col("_known")).drop("_known")
    if hot is None:
        return _follow(lanes, order).select(*cols), None
    cut = with_segment(ops, order[0], hot, only_hot=True)
    lanes = _with_starts(lanes, _segment_starts(cut, order, opening))
    return checkpointed(_follow(lanes, order).select(*cols)), hot


def pair_operations(accepted: DataFrame, order: list[str], hot=DETECT) -> DataFrame:
    """Intervals from accepted operations, which alternate open, close, open, ... per lock."""
    ts = order[0]
    paired = over_history(
        accepted, "lock_id", order, lambda w: {"released_at": F.lead(ts).over(w)}, ahead=1, hot=hot
    )
    return paired.filter(OPENS).select("lock_id", "shipment_id", F.col(ts).alias("assigned_at"), "released_at")


def _follow(ops: DataFrame, order: list[str]) -> DataFrame:
    """Keep the operations that take effect, given the shipment open at the start of each lane.

    Lanes are locks, or segments of hot locks. They are spread over the tasks and each task streams
    through its sorted rows in Arrow batches; the state is one value, so a long lane needs no memory.
    """
    schema = ops.schema

    def keep_effective(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lane, active = None, None
        for batch in batches:
            keep = []
            rows = zip(batch["lock_id"], batch[SEG], batch["shipment_id"], batch[OPENS], batch[_START])
            for lock, seg, shipment, opens, start in rows:
                if (lock, seg) != lane:
                    lane, active = (lock, seg), start if isinstance(start, str) else None
                takes = active is None if opens else active == shipment
                if takes:
                    active = shipment if opens else None
                keep.append(takes)
            yield batch[keep]

    lanes = ops.repartition("lock_id", SEG).sortWithinPartitions("lock_id", SEG, *order)
    return lanes.mapInPandas(keep_effective, schema)


def _segment_functions(ops: DataFrame, order: list[str]) -> DataFrame:
    """What each segment does to the shipment open at its start, as columns ``_from`` and ``_to``.

    A segment turns nothing (null) into some state, a shipment that it releases into the state that
    follows from nothing after that release, and leaves any other shipment open. Read backwards, that
    is one step per message: the state at the end if nothing is open here, and if a given shipment is. So
    every segment is read once, on its own, whatever comes before it.
    """
    columns = StructType([*_LANE, *(StructField(c, StringType()) for c in (_FROM, _TO))])

    def backwards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lane, nothing, released = None, None, {}

        def function() -> pd.DataFrame:
            rows = [(None, nothing), *((s, end) for s, end in released.items() if s != end)]
            return pd.DataFrame([(*lane, *row) for row in rows], columns=columns.names)

        for batch in batches:
            for lock, seg, shipment, opens in zip(batch["lock_id"], batch[SEG], batch["shipment_id"], batch[OPENS]):
                if (lock, seg) != lane:
                    if lane is not None:
                        yield function()
                    lane, nothing, released = (lock, seg), None, {}
                if opens:
                    nothing = released.get(shipment, shipment)
                else:
                    released[shipment] = nothing
        if lane is not None:
            yield function()

    newest_first = [F.desc(c) for c in order]
    lanes = ops.repartition("lock_id", SEG).sortWithinPartitions("lock_id", SEG, *newest_first)
    return lanes.select("lock_id", SEG, "shipment_id", OPENS).mapInPandas(backwards, columns)


def _segment_starts(ops: DataFrame, order: list[str], opening: DataFrame | None) -> DataFrame:
    """The shipment open at the start of every segment of the hot locks, where one is.

    The segments' functions are applied one after another; a stream over a lock's functions does, with
    one value as state. Only shipments that some segment leaves open can stand at a start, so functions are
    cut down to these first. One row per segment comes out, at most 2 * maxSplits.
    """
    functions = _segment_functions(ops, order)
    if opening is not None:
        none = F.lit(None).cast("string")
        held = opening.join(ops.select("lock_id").distinct(), "lock_id", "left_semi")
        functions = functions.unionByName(held.select("lock_id", F.lit(0).alias(SEG), none.alias(_FROM), F.col("shipment_id").alias(_TO)))
    functions = checkpointed(functions)
    left_open = functions.filter(F.col(_TO).isNotNull()).select("lock_id", F.col(_TO).alias(_FROM)).distinct()
    needed = functions.filter(F.col(_FROM).isNull()).unionByName(functions.join(left_open, ["lock_id", _FROM], "left_semi"))
    columns = StructType([*_LANE, StructField("_known", StringType())])

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lane, state, after = (None, None), None, None
        for batch in batches:
            starts = []
            for lock, seg, before, end in zip(batch["lock_id"], batch[SEG], batch[_FROM], batch[_TO]):
                if (lock, seg) != lane:
                    state = after = after if lock == lane[0] else None
                    lane = (lock, seg)
                    if state is not None:
                        starts.append((lock, seg, state))
                before, end = (x if isinstance(x, str) else None for x in (before, end))
                if before == state:
                    after = end
            yield pd.DataFrame(starts, columns=columns.names)

    ordered = needed.repartition("lock_id").sortWithinPartitions("lock_id", SEG)
    return ordered.select("lock_id", SEG, _FROM, _TO).mapInPandas(apply, columns)


def _with_starts(ops: DataFrame, starts: DataFrame) -> DataFrame:
    joined = ops.join(F.broadcast(starts), ["lock_id", SEG], "left")
    return joined.withColumn(_START, F.coalesce("_known", _START)).drop("_known")
