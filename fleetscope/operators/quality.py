"""Record validation, referential integrity and idempotent inserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope import model
from fleetscope.operators.asof import salted_join

REASON = "reason"


def required(col: str) -> tuple[str, Column]:
    return f"missing {col}", F.col(col).isNotNull()


def between(col: str, low: float, high: float) -> tuple[str, Column]:
    return f"{col} out of range", F.col(col).isNull() | F.col(col).between(low, high)


def one_of(col: str, domain: list[str]) -> tuple[str, Column]:
    return f"unknown {col}", F.col(col).isNull() | F.col(col).isin(domain)


def record_rules(record: str) -> list[tuple[str, Column]]:
    """The rules a decoded record has to meet: required fields, enum domains, coordinate ranges."""
    schema = model.schema_for(record)
    rules = [required(f.name) for f in schema if not f.nullable and f.name != "timestamp"]
    rules += [required(model.EVENT_TIME[record])]
    rules += [one_of(col, domain) for col, domain in model.ENUM_FIELDS[record].items()]
    if "latitude" in schema.names:
        rules += [between("latitude", -90, 90), between("longitude", -180, 180)]
    return rules


def failed_rule(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule a row breaks, null for a valid row."""
    broken = [F.when(~ok, F.lit(name)) for name, ok in rules]
    return F.coalesce(*broken)


def validate(df: DataFrame, rules: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """Split rows into valid ones and a quarantine that carries the reason."""
    checked = df.withColumn(REASON, failed_rule(rules))
    return checked.filter(F.col(REASON).isNull()).drop(REASON), checked.filter(F.col(REASON).isNotNull())


def enforce_fk(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Child rows whose key exists in the parent, and the orphans with a reason.

    The rows are marked by one join, so busy keys are looked for once, whichever result is read.
    """
    keys = parent.select(F.col(parent_key or key).alias(key)).distinct().withColumn("_known", F.lit(True))
    marked = salted_join(child, keys, key, "left")
    known = F.col("_known").isNotNull()
    orphans = marked.filter(~known).select(*child.columns, F.lit(f"unknown {key}").alias(REASON))
    return marked.filter(known).select(*child.columns), orphans


def insert_ignore(new: DataFrame, existing: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """The rows of ``new`` to append: first row per key, and only keys not in ``existing`` yet."""
    if order:
        cols = [c for c in new.columns if c != key]
        first = F.min_by(F.struct(*cols), F.struct(*order)).alias("_first")
        new = new.groupBy(key).agg(first).select(key, "_first.*").select(*new.columns)
    else:
        new = new.dropDuplicates([key])
    return new.join(existing.select(key), key, "left_anti")


def fk_report(checks: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """One row per declared reference (name, child, child key, parent, parent key): rows and orphans.

    The child is counted per key first, so only distinct keys are joined.
    """

    def one(name: str, child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
        per_key = child.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"))
        known = parent.select(F.col(parent_key).alias("_k")).distinct().withColumn("_known", F.lit(True))
        return per_key.join(known, "_k", "left").agg(
            F.lit(name).alias("reference"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("child_rows"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), F.lit(0)).alias("orphan_rows"),
        )

    return reduce(DataFrame.unionByName, [one(*check) for check in checks])
