"""Identifiers for new records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def new_id() -> Column:
    """A random id per row. It differs when a row is computed again: write it before using it."""
    return F.expr("uuid()")
