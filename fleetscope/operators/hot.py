"""Hot keys: finding them and cutting their history into balanced time segments.

A window partitioned by device puts one device's whole history into one task. When a single device
holds a large part of all rows that task never ends, so the history of such a device is cut at
quantiles of its own timestamps. Windows then run per (device, segment) and whatever crosses a cut
(earlier rows, running totals, last known values) is handed over by a few boundary rows per segment.

Everything collected here is bounded by construction: a key is hot when it has more than
``target = max(minRows, total / maxSplits)`` rows, so there are about ``maxSplits`` hot keys at most,
``2 * maxSplits`` segments and ``4 * maxSplits`` lookup rows, whatever the size of the data. Which
keys are hot and where they are cut is estimated from a sample; it decides where rows are worked on,
never what comes out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StructField, StructType

from fleetscope.session import small_table

MIN_ROWS = "spark.fleetscope.hot.minRows"
MAX_SPLITS = "spark.fleetscope.hot.maxSplits"
SAMPLED_PER_SPLIT = 500
SEG = "_seg"

_N, _POS, _BUCKET, _LO, _HI = "_n", "_pos", "_bucket", "_lo", "_hi"
_MIN, _MAX = -(2**63), 2**63 - 1


@dataclass(frozen=True)
class Segments:
    """Segments of the hot keys: fixed values, so every branch and retry of a plan cuts alike.

    ``table`` has one row (key, segment, first and last position) per segment, numbered from 1 in
    order. ``lookup`` lists each segment once per time bucket it touches, to find it by equality.
    """

    key: str
    keys: DataFrame
    table: DataFrame
    lookup: DataFrame
    width: int
    first_bucket: int
    last_bucket: int


def position(df: DataFrame, col: str) -> Column:
    """The ordering column as a long: microseconds for timestamps, the value itself otherwise."""
    kind = df.schema[col].dataType.typeName()
    return F.unix_micros(col) if kind == "timestamp" else F.col(col).cast("bigint")


def hot_targets(df: DataFrame, key: str) -> tuple[list, int, DataFrame] | None:
    """Hot keys as (key, segments wanted), rows per segment and the sample used; None without any."""
    conf = df.sparkSession.conf
    floor = int(conf.get(MIN_ROWS, "2000000"))
    splits = int(conf.get(MAX_SPLITS, "4096"))
    total = df.select(key).count()
    if total <= floor:
        return None
    target = max(floor, total // splits)
    fraction = min(1.0, SAMPLED_PER_SPLIT / target)
    sample = df if fraction == 1.0 else df.sample(fraction, seed=11)
    counts = sample.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(_N))
    hot = counts.filter(F.col(_N) > target * fraction).collect()  # about total / target <= maxSplits rows
    return ([(r[0], math.ceil(r[1] / fraction / target)) for r in hot], target, sample) if hot else None


def hot_segments(df: DataFrame, key: str, order: str) -> Segments | None:
    """Segments of the keys that are hot in ``df``, or None when none is."""
    found = hot_targets(df.select(key, position(df, order).alias(_POS)), key)
    if found is None:
        return None
    hot, _, sample = found
    kind = df.schema[key].dataType
    wanted = small_table(df.sparkSession, hot, StructType([StructField(key, kind), StructField(_N, LongType())]))
    pieces = max(n for _, n in hot)
    grid = [i / pieces for i in range(pieces)]
    quantiles = (
        sample.join(F.broadcast(wanted), key)
        .groupBy(key, _N)
        .agg(F.percentile_approx(_POS, grid, max(10_000, 20 * pieces)).alias("_q"), F.max(_POS).alias("_top"))
    )
    nth = lambda i: F.element_at("_q", F.floor(i * F.lit(pieces) / F.col(_N)).cast("int") + 1)
    starts = F.array_sort(F.array_distinct(F.transform(F.sequence(F.lit(1), F.col(_N) - 1), nth)))
    starts = F.when(F.col(_N) > 1, starts).otherwise(F.array().cast("array<bigint>"))
    cuts = quantiles.select(key, starts, F.element_at("_q", 1), "_top").collect()
    return _segments(df, key, kind, [tuple(r) for r in cuts])


def _segments(df: DataFrame, key: str, kind: DataType, cuts: list[tuple]) -> Segments:
    splits = int(df.sparkSession.conf.get(MAX_SPLITS, "4096"))
    # buckets reach from the first row to the last cut: what lies beyond, as open ends do, is in the last
    # segment anyway and must not stretch the buckets before
    low = min(c[2] for c in cuts)
    high = max((s for c in cuts for s in c[1] if s < c[3]), default=low)
    width = (high - low) // max(1, 2 * splits // len(cuts)) + 1
    bucket = lambda pos: min(max(pos, low), high) // width * width
    table, lookup = [], []
    for value, starts, *_ in cuts:
        edges = [_MIN, *starts, _MAX]
        for seg, (lo, hi) in enumerate(zip(edges, edges[1:]), 1):
            table.append((value, seg, lo, hi - 1))
            lookup += [(value, b, seg, lo, hi - 1) for b in range(bucket(lo), bucket(hi - 1) + 1, width)]
    named = lambda *names: StructType(
        [StructField(key, kind), *[StructField(n, IntegerType() if n == SEG else LongType()) for n in names]]
    )
    spark = df.sparkSession
    return Segments(
        key,
        F.broadcast(small_table(spark, [(c[0],) for c in cuts], named())),
        F.broadcast(small_table(spark, table, named(SEG, _LO, _HI))),
        F.broadcast(small_table(spark, lookup, named(_BUCKET, SEG, _LO, _HI))),
        width,
        bucket(low),
        bucket(high),
    )


def with_segment(df: DataFrame, order: str, hot: Segments | None, only_hot: bool = False) -> DataFrame:
    """Add the segment number: 0 for keys that are not hot, or no such rows at all with ``only_hot``."""
    if hot is None:
        return df.withColumn(SEG, F.lit(0))
    if only_hot:
        df = df.join(hot.keys, hot.key, "left_semi").select(*df.columns)
    pos = position(df, order)
    start = pos - F.pmod(pos, F.lit(hot.width))
    bucket = F.greatest(F.lit(hot.first_bucket), F.least(F.lit(hot.last_bucket), start))
    # rows without a position sort before all others, so they belong to the first segment
    bucket = F.when(pos.isNull(), F.lit(hot.first_bucket)).otherwise(bucket)
    rows = df.withColumns({"_seg_pos": F.coalesce(pos, F.lit(_MIN)), "_seg_bucket": bucket}).alias("r")
    found = (
        (F.col(f"r.{hot.key}") == F.col(f"s.{hot.key}"))
        & (F.col("_seg_bucket") == F.col(f"s.{_BUCKET}"))
        & F.col("_seg_pos").between(F.col(f"s.{_LO}"), F.col(f"s.{_HI}"))
    )
    joined = rows.join(hot.lookup.alias("s"), found, "inner" if only_hot else "left")
    return joined.select(*[f"r.{c}" for c in df.columns], F.coalesce(f"s.{SEG}", F.lit(0)).alias(SEG))


def touched_segments(df: DataFrame, lo: Column, hi: Column, hot: Segments | None) -> DataFrame:
    """Repeat each row for every segment of its key that meets ``[lo, hi]`` (positions)."""
    if hot is None:
        return df.withColumn(SEG, F.lit(0))
    rows = df.withColumns({"_seg_from": lo, "_seg_to": hi}).alias("r")
    meets = (
        (F.col(f"r.{hot.key}") == F.col(f"s.{hot.key}"))
        & (F.col("_seg_from") <= F.col(f"s.{_HI}"))
        & (F.col("_seg_to") >= F.col(f"s.{_LO}"))
    )
    joined = rows.join(hot.table.alias("s"), meets, "left")
    return joined.select(*[f"r.{c}" for c in df.columns], F.coalesce(f"s.{SEG}", F.lit(0)).alias(SEG))
