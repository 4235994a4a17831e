"""Topic sources: Kafka or NDJSON folders, decoded on the executors into typed rows."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope import model
from fleetscope.functions.timecols import from_millis
from fleetscope.sources.avro import decode_avro


@dataclass(frozen=True)
class KafkaTopic:
    """A topic read from the beginning; ``encoding`` is avro (raw datum, no registry header) or json."""

    servers: str
    topic: str
    encoding: str = "avro"
    max_offsets: int | None = None
    fail_on_data_loss: bool = True

    def options(self, streaming: bool) -> dict[str, str]:
        out = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": "earliest",
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if streaming and self.max_offsets:
            out["maxOffsetsPerTrigger"] = str(self.max_offsets)
        return out


@dataclass(frozen=True)
class JsonFolder:
    """Line-delimited JSON files of one record type; ``max_files`` bounds a micro-batch."""

    path: str
    max_files: int | None = None


def read_topic(spark: SparkSession, source: KafkaTopic | JsonFolder, record: str, streaming: bool = False) -> DataFrame:
    """Decoded rows of a topic with its event time and ``ingest_time``; lazily, as batch or stream."""
    reader = spark.readStream if streaming else spark.read
    if isinstance(source, KafkaTopic):
        raw = reader.format("kafka").options(**source.options(streaming)).load()
        decoded = decode(raw.select("value", F.col("timestamp").alias("ingest_time")), record, source.encoding)
        return normalize(decoded, record)
    reader = reader.schema(model.schema_for(record))
    if streaming and source.max_files:
        reader = reader.option("maxFilesPerTrigger", source.max_files)
    rows = reader.json(source.path)
    return normalize(rows.withColumn("ingest_time", F.col("_metadata.file_modification_time")), record)


def decode(raw: DataFrame, record: str, encoding: str = "avro") -> DataFrame:
    """Replace the binary ``value`` column by the record's columns."""
    schema = model.schema_for(record)
    if encoding == "json":
        parsed = raw.withColumn("_r", F.from_json(F.col("value").cast("string"), schema))
    elif encoding == "avro":
        parsed = decode_avro(raw, "value", "_r", record)
    else:
        raise ValueError(f"unknown encoding {encoding!r}; known: avro, json")
    others = [c for c in raw.columns if c != "value"]
    return parsed.select(*[F.col(f"_r.{f.name}").alias(f.name) for f in schema], *others)


def normalize(df: DataFrame, record: str) -> DataFrame:
    """Epoch milliseconds (or an already decoded timestamp) become the record's event-time column."""
    is_long = df.schema["timestamp"].dataType.typeName() == "long"
    at = from_millis("timestamp") if is_long else F.col("timestamp")
    return df.withColumn(model.EVENT_TIME[record], at).drop("timestamp")


def write_ndjson(df: DataFrame, root: str, record: str, mode: str = "append") -> str:
    """Write a record's rows as line-delimited JSON below ``root``; nulls are kept as fields."""
    path = os.path.join(root, record)
    df.select(*model.schema_for(record).names).write.mode(mode).option("ignoreNullFields", "false").json(path)
    return path


def avro_schema_text(record: str) -> str:
    return json.dumps(model.avro_schema_for(record))
