"""Record schemas, enum domains and static dimension seeds of the telemetry model."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# ---- fixed values: enum domains ------------------------------------------------------------------
SEVERITIES = ["low", "medium", "high", "critical"]
EVENT_TYPES = [
    "unlock_attempt",
    "tamper_detected",
    "battery_low",
    "location_deviation",
    "connection_lost",
]
WARNING_EVENTS = ["battery_low", "connection_lost"]
CRITICAL_EVENTS = ["unlock_attempt", "tamper_detected", "location_deviation"]
LOCK_STATUSES = ["active", "inactive", "tampered", "offline"]
COMPROMISED_STATUSES = ["tampered", "offline"]
SHIPMENT_STATUSES = ["in_transit", "loading", "at_destination", "stop"]
LOCK_ACTIONS = ["created", "status_changed", "assigned", "released"]
SHIPMENT_ACTIONS = ["created", "status_changed"]

# ---- fixed values: event-type dimension (type, category, description) ----------------------------
EVENT_TYPE_SEED = [
    ("unlock_attempt", "security", "An attempt to unlock the device was detected"),
    ("tamper_detected", "security", "Physical tampering with the lock was detected"),
    ("battery_low", "maintenance", "Battery level dropped below the safe threshold"),
    ("location_deviation", "logistics", "Lock moved outside the expected geofence"),
    ("connection_lost", "connectivity", "Lock lost its network connection"),
]

# ---- fixed values: penalty points per severity and score limits of the health labels -------------
PENALTY = {"critical": 25, "high": 10, "medium": 3}
PENALTY_OTHER = 1
HEALTHY_FROM = 80
WARNING_FROM = 50

# ---- fixed values: status transitions that count as anomalous ------------------------------------
ANOMALOUS_TRANSITIONS = [("active", "tampered")]

OPEN_END = "9999-12-31 23:59:59"
DIM_DATE_START = "2024-01-01"
DIM_DATE_END = "2027-12-31"


def _record(*fields) -> StructType:
    return StructType([StructField(name, kind, not required) for name, kind, required in fields])


_S, _D, _L = StringType(), DoubleType(), LongType()

RECORDS = {
    "security_event": _record(
        ("event_id", _S, True),
        ("lock_id", _S, True),
        ("event_type", _S, True),
        ("severity", _S, True),
        ("timestamp", _L, True),
    ),
    "lock_status_change": _record(
        ("lock_id", _S, True),
        ("action", _S, True),
        ("status", _S, False),
        ("previous_status", _S, False),
        ("latitude", _D, False),
        ("longitude", _D, False),
        ("shipment_id", _S, False),
        ("timestamp", _L, True),
    ),
    "location_update": _record(
        ("lock_id", _S, True),
        ("latitude", _D, True),
        ("longitude", _D, True),
        ("timestamp", _L, True),
    ),
    "shipment_status_change": _record(
        ("shipment_id", _S, True),
        ("action", _S, True),
        ("status", _S, True),
        ("previous_status", _S, False),
        ("timestamp", _L, True),
    ),
}

# Enum columns of each record, with the symbols in wire order.
ENUM_FIELDS = {
    "security_event": {"event_type": EVENT_TYPES, "severity": SEVERITIES},
    "lock_status_change": {
        "action": LOCK_ACTIONS,
        "status": LOCK_STATUSES,
        "previous_status": LOCK_STATUSES,
    },
    "location_update": {},
    "shipment_status_change": {
        "action": SHIPMENT_ACTIONS,
        "status": SHIPMENT_STATUSES,
        "previous_status": SHIPMENT_STATUSES,
    },
}

# The event-time column a decoded record gets, and the key its topic is partitioned by.
EVENT_TIME = {
    "security_event": "event_time",
    "lock_status_change": "change_time",
    "location_update": "update_time",
    "shipment_status_change": "change_time",
}
TOPIC_KEY = {
    "security_event": "lock_id",
    "lock_status_change": "lock_id",
    "location_update": "lock_id",
    "shipment_status_change": "shipment_id",
}


def schema_for(name: str) -> StructType:
    """The StructType of a named record."""
    if name not in RECORDS:
        raise ValueError(f"unknown record {name!r}; known: {sorted(RECORDS)}")
    return RECORDS[name]


def _camel(name: str) -> str:
    return "".join(part.capitalize() for part in name.split("_"))


def avro_schema_for(name: str) -> dict:
    """The Avro record schema of a named record, as a dict ready for ``json.dumps``.

    Timestamps carry the ``timestamp-millis`` logical type, optional fields are unions with null and
    enum types are named once and referred to by name afterwards, as Avro requires.
    """
    fields, named = [], {}
    for field in schema_for(name):
        symbols = ENUM_FIELDS[name].get(field.name)
        if symbols:
            kind = named.get(tuple(symbols))
            if kind is None:
                enum = _camel(name) + _camel(field.name)
                kind = {"type": "enum", "name": enum, "symbols": symbols}
                named[tuple(symbols)] = enum
        elif field.name == "timestamp":
            kind = {"type": "long", "logicalType": "timestamp-millis"}
        else:
            kind = {"string": "string", "double": "double"}[field.dataType.simpleString()]
        entry = {"name": field.name, "type": kind}
        if field.nullable:
            entry = {"name": field.name, "type": ["null", kind], "default": None}
        fields.append(entry)
    return {"type": "record", "name": _camel(name), "fields": fields}


def schema_from_avro(avro: dict) -> StructType:
    """The StructType that belongs to an Avro record schema, found by its record name."""
    wanted = avro.get("name", "")
    for name in RECORDS:
        if _camel(name) == wanted:
            return RECORDS[name]
    raise ValueError(f"no record for Avro name {wanted!r}; known: {[_camel(n) for n in RECORDS]}")
