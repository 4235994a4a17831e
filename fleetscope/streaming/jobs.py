"""Continuous jobs: topics into fact tables, windowed trends, per-device state across batches, and alerts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetscope import model
from fleetscope.functions.scoring import event_class
from fleetscope.functions.timecols import date_key
from fleetscope.operators import changelog, motion, quality
from fleetscope.operators.asof import salted_join
from fleetscope.sources.sinks import BatchTable, CarriedRows
from fleetscope.streaming import conditions, reorder

# ---- fixed values: trigger interval per record ----------------------------------------------------
TRIGGERS = {
    "security_event": "30 seconds",
    "lock_status_change": "15 seconds",
    "location_update": "60 seconds",
    "shipment_status_change": "15 seconds",
}
VALID, REJECTED, REPEATED, WAITING = "valid", "rejected", "repeated", "waiting"
# ---- fixed values: how often a row is tried before it is rejected ---------------------------------
TRIES = 3
_ATTEMPTS = "attempts"


def start(
    stream: DataFrame,
    each_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str | None,
    mode: str = "append",
) -> StreamingQuery:
    """Run ``each_batch`` on every micro-batch; without a trigger all data at hand is processed once."""
    writer = stream.writeStream.foreachBatch(each_batch).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def _kept(each_batch: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Keep the micro-batch while it is worked on, for functions that read it more than once."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            each_batch(batch, batch_id)
        finally:
            batch.unpersist()

    return run


# ---- facts ---------------------------------------------------------------------------------------


def start_fact_stream(
    stream: DataFrame,
    record: str,
    sink: BatchTable,
    checkpoint: str,
    trigger: str | None = None,
    known_locks: Callable[[], DataFrame] | None = None,
    waiting: BatchTable | None = None,
) -> StreamingQuery:
    """Decoded rows of one topic into its fact table; every row gets there, however late it is.

    Rows that break a rule, or name a lock ``known_locks`` does not have, land in the same table under
    verdict ``rejected`` with a reason. A valid event whose id the table has already, or that stands
    twice in its batch, lands there under verdict ``repeated``. So rows in are facts, rejected and
    repeated rows together, and each batch is written in one job.

    With ``waiting``, a row whose lock is unknown is not rejected at once: it goes to that table and is tried
    again with each of the next batches, against the locks known by then, ``TRIES`` times in all. Each batch
    writes all that wait after it, so rows in are facts, rejected, repeated and waiting rows at any batch.
    """
    ts = model.EVENT_TIME[record]
    rules = quality.record_rules(record)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch
        if waiting is not None:
            rows = _with_waiting(batch, batch_id, waiting)
        judged = rows.withColumn(quality.REASON, quality.failed_rule(rules))
        if known_locks is not None:
            known = known_locks().select(F.col("id").alias("lock_id")).distinct().withColumn("_known", F.lit(True))
            judged = salted_join(judged, known, "lock_id", "left")
            orphan = F.when(F.col("_known").isNull(), UNKNOWN_LOCK)
            judged = judged.withColumn(quality.REASON, F.coalesce(quality.REASON, orphan)).drop("_known")
        if waiting is not None:
            judged = judged.persist()
            again = F.coalesce((F.col(quality.REASON) == UNKNOWN_LOCK) & (F.col(_ATTEMPTS) < TRIES), F.lit(False))
            waiting.write(judged.filter(again).select(*batch.columns, _ATTEMPTS), batch_id)
            judged = judged.filter(~again).drop(_ATTEMPTS)
        verdict = F.when(F.col(quality.REASON).isNull(), VALID).otherwise(REJECTED)
        judged = judged.withColumns({"date_key": date_key(ts), "verdict": verdict})
        if record == "security_event":
            judged = _mark_repeats(judged, "event_id", ts, sink.earlier(batch.sparkSession, batch_id, _STORED))
        place = ["verdict", "date_key"]
        sink.write(judged.hint("rebalance", *place).sortWithinPartitions(*place, ts), batch_id, place)

    kept = known_locks is not None or record == "security_event"
    return start(stream, _kept(write) if kept else write, checkpoint, trigger)


UNKNOWN_LOCK = "unknown lock_id"


def _with_waiting(batch: DataFrame, batch_id: int, waiting: BatchTable) -> DataFrame:
    """The batch, first tries, and the rows that waited after the batch before, tried once more."""
    fresh = batch.withColumn(_ATTEMPTS, F.lit(1))
    if not batch_id:
        return fresh
    held = batch.sparkSession.read.schema(fresh.schema).parquet(f"{waiting.path}/batch_id={batch_id - 1}")
    return fresh.unionByName(held.withColumn(_ATTEMPTS, F.col(_ATTEMPTS) + 1))


def still_waiting(waiting: BatchTable, stream: DataFrame, last_batch: int) -> DataFrame:
    """The rows that wait after that batch, with their attempts so far."""
    schema = stream.withColumn(_ATTEMPTS, F.lit(1)).schema
    return stream.sparkSession.read.schema(schema).parquet(f"{waiting.path}/batch_id={last_batch}")


_STORED = "event_id string, batch_id int, verdict string, date_key int"


def _mark_repeats(rows: DataFrame, key: str, ts: str, stored: DataFrame | None) -> DataFrame:
    """Give valid rows whose key came before, in the batch or in ``stored``, the verdict ``repeated``.

    A delivery repeats the event's time, so only the days that the batch touches are looked up. Rows
    that are not valid may lack a key; each is then alone in its window.
    """
    valid = F.col("verdict") == VALID
    alone = F.when(~valid, F.monotonically_increasing_id())
    nth = F.row_number().over(Window.partitionBy(F.when(valid, F.col(key)), alone).orderBy(ts))
    rows = rows.withColumn("_again", valid & (nth > 1))
    if stored is not None:
        days = rows.filter(valid).select("date_key").distinct()
        known = stored.filter(F.col("verdict") == VALID).join(days, "date_key", "left_semi")
        known = known.select(F.col(key).alias("_key")).distinct()
        rows = rows.join(known, valid & (F.col(key) == F.col("_key")), "left")
        rows = rows.withColumn("_again", F.col("_again") | F.col("_key").isNotNull()).drop("_key")
    return rows.withColumn("verdict", F.when(F.col("_again"), REPEATED).otherwise(F.col("verdict"))).drop("_again")


def accounting(table: DataFrame) -> DataFrame:
    """Rows by verdict; together they are the rows that came in."""
    return table.groupBy("verdict").agg(F.count("*").alias("row_count"))


def facts(table: DataFrame) -> DataFrame:
    return table.filter(F.col("verdict") == VALID).drop("verdict", quality.REASON, "batch_id")


def dead_letters(table: DataFrame) -> DataFrame:
    return table.filter(F.col("verdict") == REJECTED).drop("verdict")


# ---- windowed aggregates -------------------------------------------------------------------------


def hourly_trend(stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Events per hour, type and severity; late events count until the watermark passes their hour."""
    return (
        stream.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 hour").alias("w"), "event_type", "severity")
        .agg(F.count("*").alias("event_count"))
        .select(F.col("w.start").alias("event_hour"), "event_type", "severity", "event_count")
    )


def sliding_critical(
    stream: DataFrame, window: str = "10 minutes", slide: str = "1 minute", delay: str = "10 minutes"
) -> DataFrame:
    """Critical events per sliding window, the stream behind the burst alert."""
    return (
        stream.filter(F.col("severity") == "critical")
        .withWatermark("event_time", delay)
        .groupBy(F.window("event_time", window, slide).alias("w"))
        .agg(F.count("*").alias("critical_events"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "critical_events")
    )


def incident_sessions(stream: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """``motion.incident_sessions`` as a stream: a session comes out when the watermark has passed its end."""
    return (
        motion.incidents(stream)
        .withWatermark("event_time", delay)
        .groupBy("lock_id", F.session_window("event_time", gap).alias("w"))
        .agg(*[value.alias(name) for name, value in motion.incident_measures().items()])
        .select("lock_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *motion.incident_measures())
    )


def start_appends(stream: DataFrame, sink: BatchTable, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Write what an append-mode aggregate gives out, each result once and final."""
    return start(stream, lambda batch, batch_id: sink.write(batch, batch_id), checkpoint, trigger)


def start_upserts(stream: DataFrame, sink: BatchTable, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Write the changed rows of an update-mode aggregate; ``BatchTable.latest`` reads the result."""
    return start(stream, lambda batch, batch_id: sink.write(batch, batch_id), checkpoint, trigger, "update")


# ---- enrichment ----------------------------------------------------------------------------------


def enrich(events: DataFrame, locks: DataFrame) -> DataFrame:
    """Events with the state of their lock and their class; unknown locks give a null state."""
    states = locks.select(F.col("id").alias("lock_id"), F.col("status").alias("lock_status"))
    return salted_join(events, states, "lock_id", "left").withColumn("event_class", event_class())


def start_enriched_stream(
    stream: DataFrame,
    load_locks: Callable[[], DataFrame],
    sink: BatchTable,
    checkpoint: str,
    trigger: str | None = None,
) -> StreamingQuery:
    """Enriched events; the lock table is read anew for each micro-batch, so it never goes stale."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sink.write(enrich(batch, load_locks()), batch_id)

    return start(stream, _kept(write), checkpoint, trigger)


# ---- per-device state ----------------------------------------------------------------------------


def start_neighbour_stream(
    stream: DataFrame,
    analyse: Callable[..., DataFrame],
    order: list[str],
    sink: BatchTable,
    carried: CarriedRows,
    checkpoint: str,
    trigger: str | None = None,
    late: BatchTable | None = None,
    ordering: reorder.Ordering = reorder.Ordering(),
) -> StreamingQuery:
    """Run an analysis that compares each row with the one before it of the same lock, as a stream.

    ``analyse`` is the function used in batch. The last row of each lock is carried to the next
    batch and put in front of its rows there, so the neighbour is found. All of it runs on the JVM
    and cuts hot locks like in batch, however much of a micro-batch one lock fills.

    With ``late``, rows are held until the watermark has passed them and so come in order; the result
    is that of the batch function over all rows that are not later than ``ordering`` allows, and the others go
    to that table. Without it, a row older than the carried one finds no neighbour and is reported as a first row.
    """
    marker = "_carried"

    def write(batch: DataFrame, batch_id: int) -> None:
        before = carried.before(batch.sparkSession, batch_id)
        rows = batch.withColumn(marker, F.lit(False))
        if before is not None:
            needed = before.join(batch.select(carried.key).distinct(), carried.key, "left_semi")
            rows = rows.unionByName(needed.withColumn(marker, F.lit(True)))
        found = analyse(rows, order, keep=[marker])
        sink.write(found.filter(~F.col(marker)).drop(marker), batch_id)
        carried.advance(batch, before, batch_id)

    return _start_ordered(stream, write, order[0], late, ordering, checkpoint, trigger)


def _start_ordered(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    ts: str,
    late: BatchTable | None,
    ordering: reorder.Ordering,
    checkpoint: str,
    trigger: str | None,
) -> StreamingQuery:
    if late is None:
        return start(stream, _kept(write), checkpoint, trigger)

    def split(batch: DataFrame, batch_id: int) -> None:
        behind = F.col(reorder.LATE)
        late.write(batch.filter(behind).drop(reorder.LATE), batch_id)
        write(batch.filter(~behind).drop(reorder.LATE), batch_id)

    return start(reorder.in_order(stream, ts, ordering), _kept(split), checkpoint, trigger)


def start_assignment_stream(
    stream: DataFrame,
    load_shipments: Callable[[], DataFrame],
    order: list[str],
    sink: BatchTable,
    carried: CarriedRows,
    checkpoint: str,
    trigger: str | None = None,
    late: BatchTable | None = None,
    ordering: reorder.Ordering = reorder.Ordering(),
) -> StreamingQuery:
    """Accepted assignment operations; what each lock has open is carried from batch to batch.

    ``late`` and ``ordering`` as in ``start_neighbour_stream``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = carried.before(spark, batch_id)
        opening = None if before is None else before.filter(changelog.OPENS).select("lock_id", "shipment_id")
        sink.write(changelog.accepted_operations(batch, load_shipments(), order, opening), batch_id)
        carried.advance(sink.read(spark, [batch_id]).drop("batch_id"), before, batch_id)

    return _start_ordered(stream, write, order[0], late, ordering, checkpoint, trigger)


# ---- alerts --------------------------------------------------------------------------------------


def start_alert_stream(
    stream: DataFrame,
    rule: conditions.Condition,
    ts: str,
    sink: BatchTable,
    checkpoint: str,
    trigger: str | None = None,
    delay: str = "10 minutes",
    key: str = "lock_id",
    tie: str = "id",
) -> StreamingQuery:
    """Each lock's alert, raised and withdrawn; ``conditions.periods`` reads the table."""
    moves = conditions.transitions(stream, rule, key, ts, tie, delay)
    return start(moves, lambda batch, batch_id: sink.write(batch, batch_id), checkpoint, trigger)


def start_share_alert_stream(
    stream: DataFrame,
    rule: conditions.Condition,
    ts: str,
    load_locks: Callable[[], DataFrame],
    limit: float,
    sink: BatchTable,
    state: BatchTable,
    checkpoint: str,
    trigger: str | None = None,
    delay: str = "10 minutes",
    key: str = "lock_id",
    tie: str = "id",
) -> StreamingQuery:
    """One alert, raised while more than ``limit`` of all locks are in the rule's condition."""
    moves = conditions.transitions(stream, rule, key, ts, tie, delay)
    return start(moves, _kept(conditions.share_flips(load_locks, limit, sink, state)), checkpoint, trigger)
