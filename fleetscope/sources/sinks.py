"""Sinks: tables in every write mode, topics, and micro-batch tables that survive replays."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetscope import model
from fleetscope.operators.ordered import latest_per_key
from fleetscope.sources.tables import Database, Lake
from fleetscope.sources.versions import Version, VersionedTable


def write_table(
    df: DataFrame,
    sink: Lake | Database,
    name: str,
    mode: str = "append",
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
) -> None:
    """Write with mode append, overwrite, ignore or error.

    Partitioned lake writes are rebalanced first: AQE merges small partitions and splits a day that
    is larger than the others, so neither tiny files nor one huge writer come out. Sorting within
    the files lets readers skip row groups.
    """
    if isinstance(sink, Database):
        df.write.mode(mode).jdbc(sink.url, name, properties=sink.properties)
        return
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*(partition_by or []), *sort_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(os.path.join(sink.root, name))


def refresh_view(df: DataFrame, sink: Lake | Database, name: str) -> None:
    """Rebuild a materialized view: the query result replaces the table as a whole."""
    write_table(df, sink, name, mode="overwrite")


def write_snapshot(df: DataFrame, sink: Lake | Database, name: str) -> int:
    """Replace a snapshot table and tell how many rows it got, counted while they were written."""
    seen = Observation(name)
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    write_table(counted, sink, name, mode="overwrite")
    return seen.get["rows"]


def topic_rows(df: DataFrame, key_col: str, encode=None) -> DataFrame:
    """Key and value columns as a topic sink needs them; JSON unless ``encode`` says otherwise."""
    record = F.struct(*df.columns)
    value = F.to_json(record) if encode is None else encode(record)
    return df.select(F.col(key_col).cast("string").alias("key"), value.alias("value"))


def write_topic(df: DataFrame, record: str, servers: str, topic: str, encode=None) -> None:
    """Publish rows keyed by the record's key, so one device stays on one topic partition."""
    rows = topic_rows(df, model.TOPIC_KEY[record], encode)
    writer = rows.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("kafka.enable.idempotence", "true").option("topic", topic).save()


@dataclass(frozen=True)
class BatchTable:
    """A table written one micro-batch at a time; each batch owns the folder ``batch_id=<id>``.

    Spark may run a batch again after a failure. The batch then replaces its own folder, so rows are
    never doubled. Readers see ``batch_id`` as a partition column.
    """

    path: str

    def write(self, df: DataFrame, batch_id: int, partition_by: list[str] | None = None) -> None:
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.path}/batch_id={batch_id}")

    def read(self, spark: SparkSession, batches: list[int] | None = None) -> DataFrame:
        reader = spark.read.option("basePath", self.path)
        if batches is None:
            return reader.parquet(self.path)
        return reader.parquet(*[f"{self.path}/batch_id={b}" for b in batches])

    def earlier(self, spark: SparkSession, batch_id: int, schema: str) -> DataFrame | None:
        """What the batches before this one have written, also when this one is run again."""
        if batch_id == 0:
            return None
        reader = spark.read.option("basePath", self.path).schema(schema)
        return reader.parquet(self.path).filter(F.col("batch_id") < batch_id)

    def latest(self, spark: SparkSession, keys: list[str]) -> DataFrame:
        """For update-mode results: the row of the last batch that touched each key."""
        df = self.read(spark)
        values = [c for c in df.columns if c not in (*keys, "batch_id")]
        last = F.max_by(F.struct(*values), F.col("batch_id")).alias("_last")
        return df.groupBy(*keys).agg(last).select(*keys, "_last.*")


@dataclass(frozen=True)
class BatchLog:
    """A ``BatchTable`` whose batches are merged as they grow old, so that very many leave few folders.

    Batches are the parts of a versioned table. ``fan`` parts of a level become one of the next; after n
    batches there are at most ``fan`` parts on each of about log n levels. Each step is a version of its own:
    readers see a batch whole or not at all, and a reader of one of the last ``keep`` versions goes on undisturbed
    while its parts are merged. A batch that is run again replaces itself, or is left out where it has been
    merged already, which is after it was committed. ``batch_id`` is a column of the rows.
    """

    path: str
    fan: int = 10
    keep: int = 10

    def write(self, df: DataFrame, batch_id: int, partition_by: list[str] | None = None) -> None:
        spark, table = df.sparkSession, VersionedTable(self.path)
        base, name = table.version(spark), _part_name(0, batch_id, batch_id)
        if base.batch is not None and batch_id <= base.batch and name not in base.parts:
            return
        rows = df.withColumn("batch_id", F.lit(batch_id))
        version = table.commit(spark, base, {name: self._store(rows, partition_by)}, max(batch_id, base.batch or 0))
        for level in range(64):
            own = sorted(p for p in version.parts if int(p.split("-")[0]) == level)
            if len(own) < self.fan:
                break
            merged = _part_name(level + 1, int(own[0].split("-")[1]), int(own[-1].split("-")[2]))
            folder = self._store(self._rows(spark, version, own), partition_by)
            version = table.commit(spark, version, dict.fromkeys(own) | {merged: folder})
            table.vacuum(spark, self.keep)

    def _store(self, rows: DataFrame, partition_by: list[str] | None) -> str:
        folder = f"{self.path}/files/{uuid.uuid4().hex}/rows"
        writer = rows.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(folder)
        return folder

    def _rows(self, spark: SparkSession, version: Version, parts: list[str], schema: str | None = None) -> DataFrame:
        reader = spark.read.schema(schema) if schema else spark.read
        # one read per part, as each has its own partition folders; parts are few
        return reduce(DataFrame.unionByName, [reader.parquet(version.parts[p]) for p in parts])

    def read(self, spark: SparkSession, batches: list[int] | None = None) -> DataFrame:
        version = VersionedTable(self.path).version(spark)
        rows = self._rows(spark, version, list(version.parts))
        return rows if batches is None else rows.filter(F.col("batch_id").isin(batches))

    def earlier(self, spark: SparkSession, batch_id: int, schema: str) -> DataFrame | None:
        """What the batches before this one have written, also when this one is run again."""
        version = VersionedTable(self.path).version(spark)
        parts = [p for p in version.parts if int(p.split("-")[1]) < batch_id]
        return self._rows(spark, version, parts, schema).filter(F.col("batch_id") < batch_id) if parts else None

    latest = BatchTable.latest


def _part_name(level: int, first: int, last: int) -> str:
    return f"{level:02d}-{first:012d}-{last:012d}"


@dataclass(frozen=True)
class CarriedRows:
    """One row per key carried from micro-batch to micro-batch.

    A batch writes only the keys it saw; every ``compact``-th batch writes all of them, so a read
    touches one full version and a bounded number of small ones. Versions are never changed after
    their batch, which makes a replayed batch see exactly the state it saw the first time.
    """

    table: BatchTable
    key: str
    order: list[str]
    compact: int = 20

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        if batch_id == 0:
            return None
        full = (batch_id - 1) // self.compact * self.compact
        rows = self.table.read(spark, list(range(full, batch_id)))
        cols = [c for c in rows.columns if c not in (self.key, "batch_id")]
        return latest_per_key(rows, self.key, ["batch_id"], cols)

    def advance(self, rows: DataFrame, carried: DataFrame | None, batch_id: int) -> None:
        """Store the latest row per key of ``rows`` and, where it is still later, of what was carried."""
        cols = [c for c in rows.columns if c != self.key]
        last = latest_per_key(rows, self.key, self.order, cols)
        if carried is not None:
            if batch_id % self.compact:
                carried = carried.join(last.select(self.key), self.key, "left_semi")
            last = latest_per_key(last.unionByName(carried), self.key, self.order, cols)
        self.table.write(last, batch_id)
