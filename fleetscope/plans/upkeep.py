"""Tables kept up from change batches: views, dimension history and dimension merges.

Each keeps what it needs in a ``VersionedTable`` and takes batches of new rows. A batch reads and rewrites
only the parts that its rows touch, in one new version, and a batch that is taken again is left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.functions.scoring import penalty, severity_flag
from fleetscope.functions.timecols import date_key
from fleetscope.operators.dims import scd2
from fleetscope.plans import health
from fleetscope.plans.trends import HOURLY, hourly_counts
from fleetscope.session import checkpointed
from fleetscope.sources.versions import Version, VersionedTable, bucket, touched


@dataclass(frozen=True)
class HourlyCounts:
    """Events per hour, type and severity, in parts by day; counts of a batch are added to those of its days."""

    table: VersionedTable
    SCHEMA = "event_hour timestamp, event_type string, severity string, event_count bigint"

    def apply(self, events: DataFrame, batch: int) -> Version:
        spark = events.sparkSession
        base = self.table.version(spark)
        if base.batch is not None and batch <= base.batch:
            return base
        new = checkpointed(hourly_counts(events.filter(F.col("event_time").isNotNull())))
        day = date_key("event_hour").cast("string")
        held = self.table.read(spark, self.SCHEMA, touched(new, day), base)
        both = held.unionByName(new).groupBy(*HOURLY).agg(F.sum("event_count").alias("event_count"))
        return self.table.commit(spark, base, self.table.stage(both, day), batch)

    def read(self, spark: SparkSession, at: Version | None = None) -> DataFrame:
        at = at or self.table.version(spark)
        return self.table.read(spark, self.SCHEMA, list(at.parts), at)


@dataclass(frozen=True)
class ShipmentHealth:
    """The multiplied counts of the health view from counts per lock and per (shipment, lock).

    A shipment's total is a sum, over its locks, of status rows x positions x events. When a batch changes
    some locks' counts, the totals change by the new products of these locks less the old ones. The three
    tables are parts of one version: ``lock-``, ``pair-`` (both by lock) and ``ship-``. Rows without a lock, which
    validation rejects, are left out.
    """

    table: VersionedTable
    buckets: int = 64

    LOCK = (
        "lock_id string, n bigint, critical bigint, high bigint, points bigint, last_event timestamp, "
        "positions bigint, last_position timestamp"
    )
    PAIR = "shipment_id string, lock_id string, rows bigint"
    SUMS = ("active_locks", "total_security_events", "critical_events", "high_events", "points")
    LASTS = ("last_security_event", "last_location_update")
    SHIP = f"shipment_id string, {', '.join(f'{c} bigint' for c in SUMS)}, {', '.join(f'{c} timestamp' for c in LASTS)}"

    def apply(self, status_changes: DataFrame, events: DataFrame, locations: DataFrame, batch: int) -> Version:
        spark = events.sparkSession
        base = self.table.version(spark)
        if base.batch is not None and batch <= base.batch:
            return base
        of_lock = lambda prefix: bucket("lock_id", self.buckets, prefix)
        counts, pairs = self._counts(events, locations), self._pairs(status_changes)
        counts, pairs = checkpointed(counts), checkpointed(pairs)
        locks = counts.select("lock_id").unionByName(pairs.select("lock_id")).distinct()
        numbers = [p.removeprefix("lock-") for p in touched(locks, of_lock("lock-"))]
        old_counts = self.table.read(spark, self.LOCK, [f"lock-{n}" for n in numbers], base)
        old_pairs = self.table.read(spark, self.PAIR, [f"pair-{n}" for n in numbers], base)
        new_counts = checkpointed(self._sum(old_counts.unionByName(counts), ["lock_id"]))
        new_pairs = checkpointed(self._sum(old_pairs.unionByName(pairs), ["shipment_id", "lock_id"]))

        def products(p: DataFrame, c: DataFrame) -> DataFrame:
            own = p.join(locks, "lock_id", "left_semi").join(c, "lock_id", "left")
            return health.multiplied(own)

        before = products(old_pairs, old_counts)
        minus = before.select("shipment_id", *[(-F.col(c)).alias(c) for c in self.SUMS], *self.LASTS)
        change = checkpointed(products(new_pairs, new_counts).unionByName(minus))
        of_ship = bucket("shipment_id", self.buckets, "ship-")
        held = self.table.read(spark, self.SHIP, touched(change, of_ship), base)
        totals = self._sum(held.unionByName(change.select(*held.columns)), ["shipment_id"])
        changed = self.table.stage(new_counts, of_lock("lock-")) | self.table.stage(new_pairs, of_lock("pair-"))
        return self.table.commit(spark, base, changed | self.table.stage(totals, of_ship), batch)

    def read(self, dim_shipment: DataFrame, at: Version | None = None) -> DataFrame:
        """The view as ``health.shipment_health`` has it."""
        spark = dim_shipment.sparkSession
        at = at or self.table.version(spark)
        totals = self.table.read(spark, self.SHIP, at.named("ship-"), at)
        return health.health_view(dim_shipment, totals, no_event=F.lit(1).cast("bigint"))

    def _counts(self, events: DataFrame, locations: DataFrame) -> DataFrame:
        per_event = events.groupBy("lock_id").agg(
            F.count("*").alias("n"),
            F.sum(severity_flag("critical")).alias("critical"),
            F.sum(severity_flag("high")).alias("high"),
            F.sum(penalty()).alias("points"),
            F.max("event_time").alias("last_event"),
        )
        per_position = locations.groupBy("lock_id").agg(F.count("*").alias("positions"), F.max("update_time").alias("last_position"))
        both = per_event.unionByName(per_position, allowMissingColumns=True)
        known = both.filter(F.col("lock_id").isNotNull())
        return self._sum(known.selectExpr(*[f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}" for c in self.LOCK.split(", ")]), ["lock_id"])

    @staticmethod
    def _pairs(status_changes: DataFrame) -> DataFrame:
        known = status_changes.filter(F.col("shipment_id").isNotNull() & F.col("lock_id").isNotNull())
        return known.groupBy("shipment_id", "lock_id").agg(F.count("*").alias("rows"))

    @staticmethod
    def _sum(rows: DataFrame, keys: list[str]) -> DataFrame:
        """Counts added up, the latest of times."""
        merged = [
            (F.max(f.name) if f.dataType.typeName() == "timestamp" else F.sum(f.name)).alias(f.name)
            for f in rows.schema.fields
            if f.name not in keys
        ]
        return rows.groupBy(*keys).agg(*merged)


@dataclass(frozen=True)
class History:
    """SCD-2 history of ``tracked`` columns that takes changes in any order.

    All states that were ever reported are kept, with those that only repeat the one before marked as such: a
    late change may come to stand between the two, and then they differ. A batch adds its states to the
    buckets of its keys, and the intervals of these buckets are closed anew.
    """

    table: VersionedTable
    key: str
    tracked: tuple[str, ...]
    ts: str
    tie: str
    schema: str  # of key, tracked, ts and tie
    buckets: int = 64

    def apply(self, changes: DataFrame, batch: int) -> Version:
        spark = changes.sparkSession
        base = self.table.version(spark)
        if base.batch is not None and batch <= base.batch:
            return base
        states = [self.key, *self.tracked, self.ts, self.tie]
        part = bucket(self.key, self.buckets)
        new = changes.select(*states)
        held = self.table.read(spark, self.schema, touched(new, part), base)
        last = F.max_by(F.struct(*self.tracked, self.tie), F.col(self.tie)).alias("_last")
        merged = held.unionByName(new).groupBy(self.key, self.ts).agg(last).select(self.key, self.ts, "_last.*")
        return self.table.commit(spark, base, self.table.stage(merged.select(*states), part), batch)

    def read(self, spark: SparkSession, at: Version | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The intervals of all keys, or of those in ``keys``, whose buckets alone are read."""
        at = at or self.table.version(spark)
        parts = list(at.parts) if keys is None else touched(keys, bucket(self.key, self.buckets))
        states = self.table.read(spark, self.schema, parts, at)
        states = states if keys is None else states.join(keys, self.key, "left_semi")
        return scd2(states, self.key, list(self.tracked), self.ts, self.tie)


@dataclass(frozen=True)
class Dimension:
    """A dimension of one row per key, merged bucket by bucket: buckets without staged rows keep their files."""

    table: VersionedTable
    key: str
    schema: str
    buckets: int = 64

    def merge(self, staged: DataFrame, batch: int | None = None) -> Version:
        """Staged rows replace those of the same key; keys are unique among them."""
        spark = staged.sparkSession
        base = self.table.version(spark)
        if batch is not None and base.batch is not None and batch <= base.batch:
            return base
        part: Column = bucket(self.key, self.buckets)
        held = self.table.read(spark, self.schema, touched(staged, part), base)
        columns = held.columns
        kept = held.join(staged.select(self.key), self.key, "left_anti")
        return self.table.commit(spark, base, self.table.stage(kept.select(*columns).unionByName(staged.select(*columns)), part), batch)

    def read(self, spark: SparkSession, at: Version | None = None) -> DataFrame:
        at = at or self.table.version(spark)
        return self.table.read(spark, self.schema, list(at.parts), at)
