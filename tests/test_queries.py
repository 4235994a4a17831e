"""Every registered query against its SQL text in DuckDB, plain and with all busy locks cut into segments."""

import os
import subprocess
import sys

import pytest
from compare import duck, duck_rows, spark_rows

from fleetscope import catalog, oracles

QUERIES = catalog.registered()
SQL = oracles.registered()
ORDERED = [
    "asof_location",
    "assignments_from_log",
    "attack_pattern",
    "daily_shipment_facts",
    "daily_shipment_summary_pit",
    "distance_delta",
    "event_sequences",
    "event_shipment_pit",
    "event_window_sql",
    "events_last_day_range",
    "events_last_hour_range",
    "fk_orphans",
    "fk_valid_events",
    "geo_heatmap",
    "geofence_table",
    "incident_bursts",
    "incident_sessions",
    "previous_status",
    "running_totals",
    "scd2_incremental",
    "scd2_lock",
    "scd2_shipment",
    "sliding_3",
    "status_durations",
    "stream_assignments",
    "stream_distance_delta",
    "stream_enriched_events",
    "stream_status_durations",
    "time_between_events",
    "time_in_status",
]


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(name, spark, sf_dir, con):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duck_rows(con, SQL[name])


@pytest.mark.parametrize("name", ORDERED)
def test_matches_sql_when_split(name, spark, sf_dir, con, split_small):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duck_rows(con, SQL[name])


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert "health_label" in df.columns and df.count() == 10


def test_the_entry_imports_without_a_session():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
