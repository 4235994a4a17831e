"""Streaming jobs run to the end of the given tables; each returns the table the job has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetscope import model
from fleetscope.functions.scoring import shipment_code
from fleetscope.operators import changelog, motion
from fleetscope.session import shared_dir
from fleetscope.sources.sinks import BatchTable, CarriedRows
from fleetscope.sources.testviews import TestViews
from fleetscope.streaming import conditions, jobs, reorder

Start = Callable[..., StreamingQuery]


def _stream(v: TestViews, name: str) -> DataFrame:
    # a pattern, because a streaming source takes a single file only by pattern
    return v.spark.readStream.schema(v.raw(name).schema).parquet(f"{v.sf_dir}/{name}.parque[t]")


def _run(v: TestViews, name: str, start: Start) -> BatchTable:
    """Start a job with its own folder for result, state and checkpoint, and wait for its end."""
    root = shared_dir(v.spark, name)
    sink = BatchTable(f"{root}/table")
    job = start(sink, f"{root}/state", f"{root}/checkpoint")
    job.awaitTermination()
    return sink


def _security_events(v: TestViews) -> DataFrame:
    return v.as_security_events(_stream(v, "events"))


def _facts(v: TestViews, record: str, rows: DataFrame) -> DataFrame:
    sink = _run(
        v,
        f"fact-{record}",
        lambda sink, state, checkpoint: jobs.start_fact_stream(rows, record, sink, checkpoint),
    )
    return jobs.facts(sink.read(v.spark))


def _as_record(rows: DataFrame, record: str) -> DataFrame:
    """Give rows all columns of a record, typed nulls where they have none."""
    ts = model.EVENT_TIME[record]
    missing = [f for f in model.schema_for(record) if f.name not in (*rows.columns, "timestamp")]
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else rows
    return rows.select(*[n for n in model.schema_for(record).names if n != "timestamp"], ts)


def fact_events(v: TestViews) -> DataFrame:
    rows = _security_events(v).withColumnRenamed("id", "event_id")
    return _facts(v, "security_event", rows)


def fact_accounting(v: TestViews) -> DataFrame:
    """Rows by verdict when every twentieth event is delivered twice, in any order, over four batches."""
    events = v.security_events().withColumnRenamed("id", "event_id")
    twice = events.filter(F.pmod(F.col("event_id").cast("bigint"), F.lit(20)) == 0)
    delivered = shared_dir(v.spark, "delivered")
    events.union(twice).repartition(4, F.xxhash64("event_time", F.monotonically_increasing_id())).write.parquet(delivered)
    stream = v.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(delivered)
    sink = _run(
        v,
        "accounting",
        lambda sink, state, checkpoint: jobs.start_fact_stream(stream, "security_event", sink, checkpoint),
    )
    return jobs.accounting(sink.read(v.spark))


def fact_retries(v: TestViews) -> DataFrame:
    """Rows by verdict when events come in four batches and a sixth of the locks is known by each more of them."""
    events = v.security_events().withColumnRenamed("id", "event_id")
    root = shared_dir(v.spark, "retries")
    sink, waiting, source = BatchTable(f"{root}/table"), BatchTable(f"{root}/waiting"), f"{root}/delivered"
    number = lambda c: F.col(c).cast("bigint")
    for n in range(4):
        events.filter(F.pmod(number("event_id"), F.lit(4)) == n).write.mode("append").parquet(source)
        stream = v.spark.readStream.schema(events.schema).parquet(source)
        known = v.locks().filter(F.pmod(number("id"), F.lit(6)) <= n)
        job = jobs.start_fact_stream(
            stream, "security_event", sink, f"{root}/checkpoint", known_locks=lambda known=known: known, waiting=waiting
        )
        job.awaitTermination()
    left = jobs.still_waiting(waiting, events, 3).agg(F.count("*").alias("row_count"))
    left = left.select(F.lit(jobs.WAITING).alias("verdict"), "row_count").filter(F.col("row_count") > 0)
    return jobs.accounting(sink.read(v.spark)).unionByName(left)


def fact_status_changes(v: TestViews) -> DataFrame:
    suppliers = F.lit(v.raw("supplier").count())  # streaming plans take no scalar subquery
    rows = v.as_status_changes(_stream(v, "events"), suppliers)
    return _facts(v, "lock_status_change", _as_record(rows, "lock_status_change"))


def fact_locations(v: TestViews) -> DataFrame:
    rows = v.as_location_updates(_stream(v, "events"))
    return _facts(v, "location_update", _as_record(rows, "location_update"))


def hourly_trend(v: TestViews) -> DataFrame:
    trend = jobs.hourly_trend(_security_events(v))
    sink = _run(v, "hourly", lambda sink, state, checkpoint: jobs.start_upserts(trend, sink, checkpoint))
    return sink.latest(v.spark, ["event_hour", "event_type", "severity"])


def sliding_critical(v: TestViews) -> DataFrame:
    bursts = jobs.sliding_critical(_security_events(v), "1 hour", "10 minutes")
    sink = _run(v, "sliding", lambda sink, state, checkpoint: jobs.start_upserts(bursts, sink, checkpoint))
    return sink.latest(v.spark, ["window_start", "window_end"])


def enriched_events(v: TestViews) -> DataFrame:
    events = _security_events(v)
    sink = _run(
        v,
        "enriched",
        lambda sink, state, checkpoint: jobs.start_enriched_stream(events, v.locks, sink, checkpoint),
    )
    return sink.read(v.spark).select("id", "lock_id", "event_type", "event_class", "lock_status", "event_time")


def _delivered(
    v: TestViews,
    name: str,
    rows: DataFrame,
    ts: str,
    delay_seconds: int,
    start: Start,
    lots: int = 2,
    values: dict[str, str] | None = None,
) -> BatchTable:
    """Deliver ``rows`` in lots, each row up to ``delay_seconds`` after its time, and run the job after each.

    Rows around the borders come in the wrong order, and each run goes on from the checkpoint of the one
    before. With the last lot comes a row without a lock from far ahead, so that the clock passes all others.
    """
    root = shared_dir(v.spark, name)
    sink, source = BatchTable(f"{root}/table"), f"{root}/delivered"
    micros = F.unix_micros(ts)
    ends = rows.agg(F.min(micros).alias("low"), F.max(micros).alias("high")).first()
    low, high = (ends["low"], ends["high"]) if ends["low"] is not None else (0, 0)
    shaken = micros + F.pmod(F.xxhash64(*rows.columns), F.lit(delay_seconds * 1_000_000))
    lot = F.coalesce(F.floor((shaken - low) * lots / (high - low + 1)), F.lit(0))
    lot = F.least(lot, F.lit(lots - 1))
    ahead = F.timestamp_micros(F.lit(high + _FAR))
    nulls = {c: F.lit(None).cast(rows.schema[c].dataType) for c in rows.columns}
    given = {c: F.lit(x) for c, x in (values or {}).items()}  # of the row that closes
    closing = v.spark.range(1, numPartitions=1).select(*[x.alias(c) for c, x in (nulls | {ts: ahead} | given).items()])
    for n in range(lots):
        own = rows.filter(lot == n)
        own = own.unionByName(closing) if n == lots - 1 else own
        own.write.mode("append").parquet(source)
        stream = v.spark.readStream.schema(rows.schema).parquet(source)
        start(stream, sink, f"{root}/state", f"{root}/checkpoint").awaitTermination()
    return sink


_SPARSE = reorder.Ordering("10 minutes", slice_seconds=21_600, lanes=4)
_FAR = 3650 * 86_400 * 1_000_000  # microseconds


def _neighbours(v: TestViews, name: str, rows: DataFrame, analyse, order: list[str]) -> DataFrame:
    def start(stream: DataFrame, sink: BatchTable, state: str, checkpoint: str) -> StreamingQuery:
        carried, late = CarriedRows(BatchTable(state), "lock_id", order), BatchTable(f"{state}-late")
        return jobs.start_neighbour_stream(stream, analyse, order, sink, carried, checkpoint, late=late, ordering=_SPARSE)

    return _delivered(v, name, rows, order[0], 300, start, lots=1).read(v.spark).drop("batch_id")


def status_durations(v: TestViews) -> DataFrame:
    rows = v.fact_lock_status_changes().select("id", "lock_id", "status", "change_time")
    return _neighbours(v, "durations", rows, motion.status_durations, ["change_time", "id"])


def distance_delta(v: TestViews) -> DataFrame:
    return _neighbours(v, "distances", v.fact_location_updates(), motion.distance_delta, ["update_time", "id"])


def alert_periods(v: TestViews, rows: DataFrame, ts: str, rule: conditions.Condition) -> DataFrame:
    """When each lock's alert was on, from rows that come up to five minutes late."""

    def start(stream: DataFrame, sink: BatchTable, state: str, checkpoint: str) -> StreamingQuery:
        return jobs.start_alert_stream(stream, rule, ts, sink, checkpoint)

    return conditions.periods(_delivered(v, rule.name, rows, ts, 300, start).read(v.spark), "lock_id")


def incident_sessions(v: TestViews, gap: str) -> DataFrame:
    def start(stream: DataFrame, sink: BatchTable, state: str, checkpoint: str) -> StreamingQuery:
        return jobs.start_appends(jobs.incident_sessions(stream, gap), sink, checkpoint)

    # the closing row has to be an incident itself, or the filter hides it from the clock
    rows = motion.incidents(v.security_events())
    sink = _delivered(v, "sessions", rows, "event_time", 300, start, values={"severity": "high"})
    return sink.read(v.spark).filter(F.col("lock_id").isNotNull()).drop("batch_id")


def share_alerts(v: TestViews, rows: DataFrame, ts: str, rule: conditions.Condition, limit: float) -> DataFrame:
    """When the share of locks in the rule's condition went over ``limit`` and back."""

    def start(stream: DataFrame, sink: BatchTable, state: str, checkpoint: str) -> StreamingQuery:
        return jobs.start_share_alert_stream(stream, rule, ts, v.locks, limit, sink, BatchTable(state), checkpoint)

    return _delivered(v, rule.name, rows, ts, 300, start).read(v.spark).drop("batch_id")


def assignments(v: TestViews) -> DataFrame:
    rows = v.assignment_log(v.lock_assignments().withColumn("shipment_id", shipment_code("shipment_pk")))
    order = ["change_time", "seq"]

    def start(stream: DataFrame, sink: BatchTable, state: str, checkpoint: str) -> StreamingQuery:
        carried, late = CarriedRows(BatchTable(state), "lock_id", order), BatchTable(f"{state}-late")
        return jobs.start_assignment_stream(stream, v.shipments, order, sink, carried, checkpoint, late=late, ordering=_SPARSE)

    accepted = _delivered(v, "assignments", rows, "change_time", 300, start).read(v.spark)
    return changelog.pair_operations(accepted, order)
