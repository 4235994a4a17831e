"""The telemetry tables as views over the generic test tables (`events`, `orders`, `customer`, `supplier`)."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.functions.scoring import shipment_code
from fleetscope.functions.timecols import with_date_key
from fleetscope.operators.ordered import latest_per_key

EPOCH = "2024-01-01 00:00:00"
AS_OF = "2024-01-31 00:00:00"


def _pick(number: Column, values: list[str]) -> Column:
    out = F.lit(values[-1])
    for i, value in enumerate(values[:-1]):
        out = F.when(number % len(values) == i, value).otherwise(out)
    return out


def _after_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(F.lit(EPOCH)) + seconds)


def _coordinate(base: float, number: Column, factor: int) -> Column:
    return F.lit(base) + (number * factor) % 1000 / F.lit(1000.0)


class TestViews:
    """Lazy access to the domain tables over one test-data folder."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:  # reading the schema from the footers is a job of its own
            self._raw[name] = self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
        return self._raw[name]

    def _supplier_count(self) -> Column:
        return self.raw("supplier").agg(F.count("*")).scalar()

    # ---- events ----------------------------------------------------------------------------------

    @staticmethod
    def as_security_events(events: DataFrame) -> DataFrame:
        kind, value = F.col("event_type"), F.col("value")
        return events.select(
            F.col("event_id").cast("string").alias("id"),
            F.col("user_id").cast("string").alias("lock_id"),
            F.when(kind == "error", "tamper_detected")
            .when(kind == "click", "unlock_attempt")
            .when(kind == "view", "location_deviation")
            .when(kind == "signup", "connection_lost")
            .otherwise("battery_low")
            .alias("event_type"),
            F.when(value >= 148, "critical")
            .when(value >= 80, "high")
            .when(value >= 35, "medium")
            .otherwise("low")
            .alias("severity"),
            F.col("ts").cast("timestamp").alias("event_time"),
        )

    def security_events(self) -> DataFrame:
        return self.as_security_events(self.raw("events"))

    def fact_security_events(self) -> DataFrame:
        return with_date_key(self.security_events().withColumnRenamed("id", "event_id"), "event_time")

    def arrivals(self) -> DataFrame:
        """Events with an arrival time: one in twenty is 1 to 15 minutes late."""
        number = F.col("id").cast("bigint")
        late = F.when(number % 20 == 0, 60 + number % 841).otherwise(0)
        return self.security_events().withColumn(
            "ingest_time", F.timestamp_micros(F.unix_micros("event_time") + late * 1_000_000)
        )

    # ---- current-state tables --------------------------------------------------------------------

    def locks(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").select(
            key.cast("string").alias("id"),
            _pick(key, ["active", "inactive", "tampered", "offline"]).alias("status"),
            F.lit(AS_OF).cast("timestamp").alias("last_update"),
        )

    def shipments(self) -> DataFrame:
        pk = F.col("s_suppkey") + 1
        return self.raw("supplier").select(
            pk.alias("shipment_pk"),
            shipment_code(pk).alias("shipment_id"),
            _pick(F.col("s_nationkey"), ["in_transit", "loading", "at_destination", "stop"]).alias("status"),
            F.lit(AS_OF).cast("timestamp").alias("last_update"),
        )

    def dim_shipment(self) -> DataFrame:
        return self.shipments().withColumn("is_current", F.lit(True))

    @staticmethod
    def as_assignments(orders: DataFrame, suppliers: Column) -> DataFrame:
        key = F.col("o_orderkey")
        start = (key * 7919) % 2592000
        end = start + (key % 72 + 1) * 3600
        return orders.select(
            key.alias("id"),
            F.col("o_custkey").cast("string").alias("lock_id"),
            (key % suppliers + 1).alias("shipment_pk"),
            _after_epoch(start).alias("assigned_at"),
            F.when(F.col("o_orderstatus") != "O", _after_epoch(end)).alias("released_at"),
        )

    def lock_assignments(self) -> DataFrame:
        return self.as_assignments(self.raw("orders"), self._supplier_count())

    # ---- facts -----------------------------------------------------------------------------------

    @staticmethod
    def as_location_updates(events: DataFrame) -> DataFrame:
        key = F.col("event_id")
        return events.filter(key % 2 == 1).select(
            key.alias("id"),
            F.col("user_id").cast("string").alias("lock_id"),
            _coordinate(-34.0, key, 37).alias("latitude"),
            _coordinate(-60.0, key, 53).alias("longitude"),
            F.col("ts").cast("timestamp").alias("update_time"),
        )

    def fact_location_updates(self) -> DataFrame:
        return self.as_location_updates(self.raw("events"))

    def locations(self) -> DataFrame:
        return latest_per_key(
            self.fact_location_updates(), "lock_id", ["update_time", "id"], ["latitude", "longitude"]
        )

    @staticmethod
    def as_status_changes(events: DataFrame, suppliers: Column) -> DataFrame:
        key, lock = F.col("event_id"), F.col("user_id")
        return events.filter(key % 3 == 0).select(
            key.alias("id"),
            lock.cast("string").alias("lock_id"),
            F.lit("status_changed").alias("action"),
            _pick(F.floor(key / 3), ["active", "inactive", "tampered", "offline"]).alias("status"),
            F.when(lock % 3 == 0, shipment_code(lock % suppliers + 1)).alias("shipment_id"),
            F.col("ts").cast("timestamp").alias("change_time"),
        )

    def fact_lock_status_changes(self) -> DataFrame:
        return self.as_status_changes(self.raw("events"), self._supplier_count())

    # ---- change logs; `seq` is the arrival number ------------------------------------------------

    def lock_status_log(self) -> DataFrame:
        key = F.col("c_custkey")
        has_place = key % 5 != 0
        none = F.lit(None)
        created = self.raw("customer").select(
            key.cast("string").alias("lock_id"),
            F.lit("created").alias("action"),
            _pick(key, ["active", "inactive", "tampered", "offline"]).alias("status"),
            F.when(has_place, _coordinate(-34.0, key, 37)).alias("latitude"),
            F.when(has_place, _coordinate(-60.0, key, 53)).alias("longitude"),
            none.cast("string").alias("shipment_id"),
            _after_epoch((key * 7919) % 864000).alias("change_time"),
            (key * 4).alias("seq"),
        )
        changed = self.fact_lock_status_changes().select(
            "lock_id", "action", "status", "shipment_id", "change_time", (F.col("id") * 4 + 1).alias("seq")
        )
        held = self.lock_assignments().withColumn("shipment_id", shipment_code("shipment_pk"))
        ops = self.assignment_log(held)
        logs = created.unionByName(changed, allowMissingColumns=True).unionByName(ops, allowMissingColumns=True)
        return logs.withColumn("previous_status", none.cast("string"))

    @staticmethod
    def assignment_log(held: DataFrame) -> DataFrame:
        """An assigned and, where it ended, a released message per assignment."""
        messages = F.array(
            F.struct(
                F.lit("assigned").alias("action"),
                F.col("assigned_at").alias("change_time"),
                (F.col("id") * 4 + 2).alias("seq"),
            ),
            F.struct(
                F.lit("released").alias("action"),
                F.col("released_at").alias("change_time"),
                (F.col("id") * 4 + 3).alias("seq"),
            ),
        )
        log = held.select("lock_id", "shipment_id", F.inline(messages))
        return log.filter(F.col("change_time").isNotNull())

    def location_log(self) -> DataFrame:
        return self.fact_location_updates().select(
            "lock_id",
            "latitude",
            "longitude",
            F.col("update_time").alias("change_time"),
            (F.col("id") * 4 + 1).alias("seq"),
        )

    def shipment_log(self) -> DataFrame:
        key = F.col("s_suppkey")
        created = self.raw("supplier").select(
            shipment_code(key + 1).alias("shipment_id"),
            F.lit("created").alias("action"),
            _pick(F.col("s_nationkey"), ["in_transit", "loading", "at_destination", "stop"]).alias("status"),
            _after_epoch((key * 3571) % 432000).alias("change_time"),
            (key * 2).alias("seq"),
        )
        changed = self.lock_assignments().select(
            shipment_code("shipment_pk").alias("shipment_id"),
            F.lit("status_changed").alias("action"),
            _pick(F.col("id"), ["in_transit", "loading", "at_destination", "stop"]).alias("status"),
            F.col("assigned_at").alias("change_time"),
            (F.col("id") * 2 + 1).alias("seq"),
        )
        return created.unionByName(changed)

    def fences(self) -> DataFrame:
        """A circle of 1 to 20 km around each supplier."""
        key = F.col("s_suppkey")
        return self.raw("supplier").select(
            key.alias("fence_id"),
            _coordinate(-34.0, key, 61).alias("latitude"),
            _coordinate(-60.0, key, 87).alias("longitude"),
            ((key % 20 + 1) * 1000.0).alias("radius_m"),
        )

    # ---- device readings -------------------------------------------------------------------------

    def battery_readings(self) -> DataFrame:
        return self.raw("events").select(
            F.col("event_id").alias("id"),
            F.col("user_id").cast("string").alias("lock_id"),
            ((F.col("event_id") * 7919 + F.col("user_id")) % 101).cast("int").alias("battery_pct"),
            F.col("ts").cast("timestamp").alias("reading_time"),
        )

    def route_progress(self, routes: list[str]) -> DataFrame:
        """Positions with the route their lock follows and its progress along it."""
        number = F.col("id")
        return self.fact_location_updates().select(
            "id",
            "lock_id",
            "latitude",
            "longitude",
            "update_time",
            _pick(F.col("lock_id").cast("bigint"), routes).alias("route"),
            (number % 1001 / F.lit(1000.0)).alias("progress"),
        )

    def all(self) -> dict[str, DataFrame]:
        names = [
            "locks",
            "security_events",
            "shipments",
            "lock_assignments",
            "locations",
            "fact_location_updates",
            "fact_lock_status_changes",
        ]
        return {name: getattr(self, name)() for name in names}
