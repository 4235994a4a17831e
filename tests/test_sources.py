"""Schemas, decoding, sinks and views."""

import json
import struct
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetscope import model
from fleetscope.operators import dims
from fleetscope.sources import avro, sinks, tables, topics


def test_schema_lookup():
    for name in model.RECORDS:
        avro = json.loads(topics.avro_schema_text(name))
        assert [f["name"] for f in avro["fields"]] == model.schema_for(name).names
        assert model.schema_from_avro(avro) == model.schema_for(name)
    with pytest.raises(ValueError):
        model.schema_for("door_opened")
    with pytest.raises(ValueError):
        model.schema_from_avro({"name": "DoorOpened"})


def _long(n):
    n = (n << 1) ^ (n >> 63)
    out = b""
    while n > 0x7F:
        out += bytes([n & 0x7F | 0x80])
        n >>= 7
    return out + bytes([n])


def _text(s):
    return _long(len(s.encode())) + s.encode()


def has_avro(spark):
    try:
        topics.decode(spark.createDataFrame([(bytearray(b""),)], "value binary"), "lock_status_change")
    except RuntimeError:
        return False
    return True


def test_without_the_avro_package_its_name_is_told(spark):
    if has_avro(spark):
        pytest.skip("spark-avro is there")
    raw = spark.createDataFrame([(bytearray(b""),)], "value binary")
    with pytest.raises(RuntimeError, match=avro.PACKAGE):
        topics.decode(raw, "lock_status_change")


def test_avro_datums(spark):
    if not has_avro(spark):
        pytest.skip("spark-avro is not there")
    at = 1_704_067_200_123
    full = (
        _text("läck-1") + _long(1) + _long(1) + _long(2) + _long(0) + _long(1) + struct.pack("<d", -34.5)
        + _long(1) + struct.pack("<d", 60.25) + _long(0) + _long(at)
    )
    rows = [(bytearray(full),), (bytearray(b"\x02"),), (None,)]
    raw = spark.createDataFrame(rows, "value binary").withColumn("ingest_time", F.lit("2024-01-01").cast("timestamp"))
    out = topics.normalize(topics.decode(raw, "lock_status_change"), "lock_status_change").collect()
    row = next(r for r in out if r["lock_id"])
    assert (row["lock_id"], row["action"], row["status"], row["previous_status"]) == ("läck-1", "status_changed", "tampered", None)
    assert (row["latitude"], row["longitude"], row["shipment_id"]) == (-34.5, 60.25, None)
    assert row["change_time"] == datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert sum(r["lock_id"] is None for r in out) == 2


def test_json_values(spark):
    rows = spark.createDataFrame([("e1", "a", "battery_low", "low", 1_704_067_200_000)], model.schema_for("security_event"))
    sent = sinks.topic_rows(rows, "lock_id").withColumn("value", F.col("value").cast("binary"))
    assert sent.first()["key"] == "a"
    back = topics.decode(sent.drop("key"), "security_event", "json")
    assert back.collect() == rows.collect()
    with pytest.raises(ValueError):
        topics.decode(sent, "security_event", "xml")


def test_ndjson_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("S1", "created", "stop", None, 1_704_067_200_000)], model.schema_for("shipment_status_change"))
    path = topics.write_ndjson(rows, str(tmp_path), "shipment_status_change")
    text = spark.read.text(path).first()[0]
    assert json.loads(text)["previous_status"] is None
    back = topics.read_topic(spark, topics.JsonFolder(path), "shipment_status_change")
    assert back.first()["change_time"] == datetime(2024, 1, 1) and "ingest_time" in back.columns


def test_kafka_options():
    topic = topics.KafkaTopic("host:9092", "events", max_offsets=10)
    assert topic.options(streaming=True)["maxOffsetsPerTrigger"] == "10"
    assert topic.options(streaming=False)["startingOffsets"] == "earliest"


def test_table_modes(spark, tmp_path):
    lake = tables.Lake(str(tmp_path))
    df = spark.range(100).withColumn("date_key", (F.col("id") % 3 + 20240101).cast("int"))
    sinks.write_table(df, lake, "t", partition_by=["date_key"], sort_by=["id"])
    sinks.write_table(df, lake, "t", partition_by=["date_key"])
    assert tables.read_table(spark, lake, "t").count() == 200
    sinks.write_table(df, lake, "t", mode="ignore")
    assert tables.read_table(spark, lake, "t").count() == 200
    sinks.refresh_view(df, lake, "t")
    assert tables.read_table(spark, lake, "t").count() == 100
    with pytest.raises(Exception, match="already exists"):
        sinks.write_table(df, lake, "t", mode="error")


def test_snapshot_counts_while_writing(spark, tmp_path):
    lake = tables.Lake(str(tmp_path))
    assert sinks.write_snapshot(spark.range(42).toDF("id"), lake, "s") == 42


def test_partition_pruning(spark, tmp_path):
    lake = tables.Lake(str(tmp_path))
    df = spark.range(10).withColumn("date_key", (F.col("id") + 20240101).cast("int"))
    sinks.write_table(df, lake, "t", partition_by=["date_key"])
    plan = tables.read_table(spark, lake, "t").filter("date_key = 20240103")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_key" in plan


def test_views_and_listing(spark):
    tables.register_views({"view_a": spark.range(3), "view_b": spark.range(4)})
    names = {r["table_name"] for r in tables.list_tables(spark).collect()}
    assert {"view_a", "view_b"} <= names
    assert tables.run_query(spark, tables.Lake("x"), "select count(*) as n from view_b").first()["n"] == 4
    counts = {r["table_name"]: r["row_count"] for r in tables.table_counts({"a": spark.range(3)}).collect()}
    assert counts == {"a": 3}


def test_database_from_env(monkeypatch):
    for name, value in {"DW_JDBC_URL": "jdbc:x", "DW_USER": "u", "DW_PASSWORD": "p"}.items():
        monkeypatch.setenv(name, value)
    source = tables.Database.from_env("DW")
    assert source.url == "jdbc:x" and source.properties["user"] == "u"
    assert "p" not in repr(source).split("jdbc:x")[1]


def test_event_type_dimension(spark):
    rows = {r["event_type"]: (r["category"], r["event_class"]) for r in dims.dim_event_type(spark).collect()}
    assert rows["battery_low"] == ("maintenance", "WARNING") and rows["tamper_detected"] == ("security", "CRITICAL")
    assert len(rows) == 5


def test_new_ids_are_distinct(spark):
    from fleetscope.functions.ids import new_id

    ids = spark.range(100).select(new_id().alias("id"))
    assert {len(r["id"]) for r in ids.collect()} == {36} and ids.distinct().count() == 100
