"""Severity flags, penalty scores, labels and event classes as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetscope import model


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0; as bigint so sums cannot overflow an int."""
    return F.when(condition, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def severity_flag(level: str, col: str = "severity") -> Column:
    return flag(F.col(col) == level)


def penalty(col: str = "severity") -> Column:
    points = F.lit(model.PENALTY_OTHER)
    for level, value in model.PENALTY.items():
        points = F.when(F.col(col) == level, value).otherwise(points)
    return points.cast("bigint")


def score(penalty_sum) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), F.lit(100).cast("bigint") - penalty_sum)


def health_label(col: str = "health_score") -> Column:
    return (
        F.when(F.col(col) >= model.HEALTHY_FROM, "HEALTHY")
        .when(F.col(col) >= model.WARNING_FROM, "WARNING")
        .otherwise("CRITICAL")
    )


def event_class(col: str = "event_type") -> Column:
    return (
        F.when(F.col(col).isin(model.CRITICAL_EVENTS), "CRITICAL")
        .when(F.col(col).isin(model.WARNING_EVENTS), "WARNING")
    )


def is_compromised(col: str = "status") -> Column:
    return F.col(col).isin(model.COMPROMISED_STATUSES)


def overall_status(critical: Column, warning: Column) -> Column:
    """ok / warning / critical from two counts; critical wins."""
    return F.when(critical > 0, "critical").when(warning > 0, "warning").otherwise("ok")


def shipment_code(pk) -> Column:
    return F.format_string("SHIP%010d", pk)
