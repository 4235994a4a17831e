"""Static dimensions, SCD-2 history and dimension merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fleetscope import model
from fleetscope.functions.scoring import event_class
from fleetscope.functions.timecols import date_key, day_of_week0
from fleetscope.operators.hot import hot_segments
from fleetscope.operators.ordered import over_history
from fleetscope.session import checkpointed, small_table


def dim_date(spark: SparkSession, start: str = model.DIM_DATE_START, end: str = model.DIM_DATE_END) -> DataFrame:
    """One row per day, generated on the executors; 1,461 rows for the default range."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("full_date")
    )
    dow = day_of_week0("full_date")
    return days.select(
        date_key("full_date").alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"),
        F.dayofmonth("full_date").alias("day"),
        F.weekofyear("full_date").alias("week"),
        dow.alias("day_of_week"),
        dow.isin(0, 6).alias("is_weekend"),
    )


def dim_event_type(spark: SparkSession) -> DataFrame:
    columns = ("event_type", "category", "description")
    schema = StructType([StructField(name, StringType()) for name in columns])
    seed = small_table(spark, model.EVENT_TYPE_SEED, schema)
    return seed.withColumn("event_class", event_class())


def scd2(changes: DataFrame, key: str, tracked: list[str], ts: str, tie: str) -> DataFrame:
    """Validity intervals per key: one row per real change of the tracked columns.

    Rows that repeat the values before them are dropped; an interval ends where the next one starts
    and the last one stays open. Changes at exactly the same time collapse to the last of them.
    """
    state = F.struct(*tracked)
    last_at = changes.groupBy(key, ts).agg(F.max_by(state, F.col(tie)).alias("_state"))
    hot = hot_segments(changes, key, ts)
    marked = over_history(
        last_at, key, [ts], lambda w: {"_before": F.lag("_state").over(w)}, back=1, hot=hot
    ).filter(F.col("_before").isNull() | ~F.col("_state").eqNullSafe(F.col("_before")))
    marked = marked.drop("_before")
    if hot is not None:
        marked = checkpointed(marked)  # read several times below
    closed = over_history(
        marked, key, [ts], lambda w: {"_next": F.lead(ts).over(w)}, ahead=1, hot=hot
    )
    return closed.select(
        key,
        *[F.col(f"_state.{c}").alias(c) for c in tracked],
        F.col(ts).alias("effective_from"),
        F.coalesce("_next", F.lit(model.OPEN_END).cast("timestamp")).alias("effective_to"),
        F.col("_next").isNull().alias("is_current"),
    )


def current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def with_active_flag(assignments: DataFrame) -> DataFrame:
    """The assignment dimension: assignments with ``is_active``."""
    return assignments.withColumn("is_active", F.col("released_at").isNull())


def merge_dimension(existing: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """Upsert: staged rows replace existing ones of the same key, new keys are added."""
    values = [c for c in existing.columns if c != key]
    pairs = existing.alias("e").join(staged.alias("s"), F.col(f"e.{key}") == F.col(f"s.{key}"), "full")
    is_staged = F.col(f"s.{key}").isNotNull()
    return pairs.select(
        F.coalesce(f"s.{key}", f"e.{key}").alias(key),
        *[F.when(is_staged, F.col(f"s.{c}")).otherwise(F.col(f"e.{c}")).alias(c) for c in values],
    )
