"""As-of joins, interval joins and interval totals on a device key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fleetscope.model import OPEN_END
from fleetscope.operators.hot import SEG, hot_segments, hot_targets, touched_segments, with_segment
from fleetscope.operators.ordered import over_history, running
from fleetscope.session import small_table

_AT, _SIDE, _TIE, _HIT = "_at", "_side", "_tie", "_hit"
#: Cells of an interval join: microseconds of the smallest, as a power of two how many make one of the next size,
#: and how many sizes. The largest are of 8^8 hours, so that no two timestamps are more than a few of them apart.
HOUR, BITS, LEVELS = 3_600_000_000, 3, 9
DAY = 24 * HOUR


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    left_ts: str,
    right_ts: str,
    cols: list[str],
    right_tie: str,
) -> DataFrame:
    """Each left row with ``cols`` of the latest right row at or before its time (null if none).

    Right rows at equal times collapse to the one with the greatest ``right_tie``. Both sides are
    laid into one ordered history per key and the last right row is carried forward, so the cost is
    one shuffle and linear in the rows.
    """
    hit = F.struct(F.col(right_ts).alias(_AT), F.col(right_tie).alias(_TIE), *cols)
    probes = left.withColumns({_AT: F.col(left_ts), _SIDE: F.lit(1)})
    marks = right.select(on, F.col(right_ts).alias(_AT), F.lit(0).alias(_SIDE), hit.alias(_HIT))
    marks = marks.filter(F.col(_AT).isNotNull())
    rows = probes.unionByName(marks, allowMissingColumns=True)

    hot = hot_segments(rows, on, _AT)
    if hot is None:
        rows = with_segment(rows, _AT, None)
    else:
        opening = _opening_hits(with_segment(rows.select(on, _AT, _HIT), _AT, hot, only_hot=True), on)
        rows = with_segment(rows, _AT, hot).unionByName(opening, allowMissingColumns=True)
    w = Window.partitionBy(on, SEG).orderBy(_AT, _SIDE, F.col(f"{_HIT}.{_TIE}"))
    found = F.last(_HIT, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        rows.withColumn(_HIT, found)
        .filter(F.col(_SIDE) == 1)
        .select(*left.columns, *[F.col(f"{_HIT}.{c}").alias(c) for c in cols])
    )


def _opening_hits(rows: DataFrame, on: str) -> DataFrame:
    """For each segment after the first, the last right row of all segments before it."""
    lane = Window.partitionBy(on).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    order = F.struct(F.col(f"{_HIT}.{_AT}"), F.col(f"{_HIT}.{_TIE}"))
    per_seg = rows.groupBy(on, SEG).agg(
        F.max_by(F.col(_HIT), F.when(F.col(_HIT).isNotNull(), order)).alias(_HIT)
    )
    carried = per_seg.withColumn(_HIT, F.last(_HIT, ignorenulls=True).over(lane)).filter(F.col(_HIT).isNotNull())
    return carried.select(on, SEG, _HIT, F.lit(0).alias(_SIDE), F.col(f"{_HIT}.{_AT}").alias(_AT))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    ts: str,
    start: str,
    end: str,
    cols: list[str],
    how: str = "left",
    unit: int = HOUR,
) -> DataFrame:
    """Each left row with ``cols`` of every right row whose ``[start, end)`` holds its time.

    A null ``end`` is an open interval. The range condition is turned into an equi-join: intervals
    are clipped to the time their key has left rows at all and cut into cells, the largest that fit:
    of one unit (microseconds), of 8 units, of 64 and so on, at most 14 of each size. A left row looks
    up its cell of each size that occurs, so both sides grow by the logarithm of an interval's length
    only. Cells of a hot key are cut further at its segment bounds: an interval is listed once more for
    each segment that it covers and whose rows it is joined to anyway.

    With ``how`` left, rows that no interval holds are told by running totals of starts and ends and
    do not take part in the join.
    """
    spans = left.groupBy(on).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    hot = hot_segments(left, on, ts)
    held = (
        right.select(on, F.col(start).alias("_start"), F.col(end).alias("_end"), F.struct(*cols).alias("_cols"))
        .join(spans, on)
        .filter((F.col("_start") <= F.col("_hi")) & F.coalesce(F.col("_end") > F.col("_lo"), F.lit(True)))
        .filter(F.coalesce(F.col("_start") < F.col("_end"), F.lit(True)))
    )
    first = F.unix_micros(F.greatest("_start", "_lo"))
    last = F.unix_micros(F.least(F.coalesce("_end", "_hi"), "_hi"))
    cells = _cells(_unit(first, unit), _unit(last, unit))
    pieces = held.withColumns({"_from": first, "_to": last}).withColumn("_cell", F.explode(cells))
    width = F.call_function("shiftleft", F.lit(unit).cast("bigint"), BITS * F.col("_cell.level"))
    low = F.greatest("_from", F.col("_cell.number") * width)
    high = F.least("_to", (F.col("_cell.number") + 1) * width - 1)
    pieces = touched_segments(pieces, low, high, hot).select(on, "_start", "_end", "_cell", SEG, "_cols")

    sizes = pieces.agg(F.array_sort(F.collect_set("_cell.level"))).scalar()  # at most LEVELS of them
    number = lambda level: F.call_function("shiftright", _unit(F.unix_micros(ts), unit), BITS * level)
    looked_up = F.transform("_sizes", lambda level: F.struct(level.alias("level"), number(level).alias("number")))
    covered, bare = (left, None) if how == "inner" else _covered(left, right, on, ts, start, end)
    probes = with_segment(covered, ts, hot).withColumn("_sizes", sizes).withColumn("_cell", F.explode(looked_up))
    holds = (F.col(f"p.{ts}") >= F.col("i._start")) & F.coalesce(
        F.col(f"p.{ts}") < F.col("i._end"), F.lit(True)
    )
    same = [F.col(f"p.{c}") == F.col(f"i.{c}") for c in (on, "_cell", SEG)]
    joined = probes.alias("p").join(pieces.alias("i"), [*same, holds])
    out = joined.select(*[f"p.{c}" for c in left.columns], *[F.col(f"i._cols.{c}").alias(c) for c in cols])
    return out if bare is None else out.unionByName(bare, allowMissingColumns=True)


def _unit(micros: Column, unit: int) -> Column:
    """The number of the unit that a time in microseconds lies in, in whole numbers."""
    return F.call_function("div", micros - F.pmod(micros, F.lit(unit)), F.lit(unit))


def _cells(first: Column, last: Column) -> Column:
    """The units ``first`` to ``last`` as few cells (level, number) of 2^(BITS * level) units each."""
    none = F.array().cast("array<struct<level:int,number:bigint>>")

    def step(acc: Column, level: Column) -> Column:
        low, high = acc["low"], acc["high"]  # of the units of the level, high not included
        up, down = F.shiftright(low + (2**BITS - 1), BITS), F.shiftright(high, BITS)
        apart = F.coalesce((level < LEVELS - 1) & (up < down), F.lit(False))  # whole cells of the next size lie between
        head, tail = (F.when(apart, F.shiftleft(x, BITS)).otherwise(high) for x in (up, down))
        cells = F.concat(acc["cells"], _range(level, low, head), _range(level, tail, high))
        return F.struct(F.when(apart, up).alias("low"), F.when(apart, down).alias("high"), cells.alias("cells"))

    begin = F.struct(first.alias("low"), (last + 1).alias("high"), none.alias("cells"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS - 1)), begin, step, lambda acc: acc["cells"])


def _range(level: Column, low: Column, high: Column) -> Column:
    """Cells ``low`` to before ``high`` of a level; none where ``low`` is null or not less."""
    cell = lambda n: F.struct(level.alias("level"), n.alias("number"))
    none = F.array().cast("array<struct<level:int,number:bigint>>")
    return F.when(low < high, F.transform(F.sequence(low, high - 1), cell)).otherwise(none)


def _covered(
    left: DataFrame, right: DataFrame, on: str, ts: str, start: str, end: str
) -> tuple[DataFrame, DataFrame]:
    """The left rows that some interval of their key holds, and the others."""
    ends = F.array(
        F.struct(F.col(start).alias(_AT), F.lit(1).alias("_step")),
        F.struct(F.col(end).alias(_AT), F.lit(-1).alias("_step")),
    )
    valid = right.filter(F.coalesce(F.col(start) < F.col(end), F.col(start).isNotNull()))
    steps = valid.select(on, F.inline(ends), F.lit(0).alias(_SIDE)).filter(F.col(_AT).isNotNull())
    rows = left.withColumns({_AT: F.col(ts), _SIDE: F.lit(1), "_step": F.lit(0)})
    moves = steps.unionByName(rows, allowMissingColumns=True)
    counted = over_history(
        moves, on, [_AT, _SIDE], lambda w: {"_open": running("_net", w)}, totals={"_net": F.col("_step").cast("bigint")}
    ).filter(F.col(_SIDE) == 1)
    known = F.col(on).isNotNull() & F.col(ts).isNotNull()
    inside = known & (F.col("_open") > 0)
    return counted.filter(inside).select(*left.columns), counted.filter(~inside).select(*left.columns)


def interval_totals(
    points: DataFrame,
    intervals: DataFrame,
    on: str,
    ts: str,
    start: str,
    end: str,
    measures: list[str],
    by: list[str],
) -> DataFrame:
    """Sums of the points' ``measures`` within each interval ``[start, end)``, grouped ``by`` interval columns.

    The same answer as joining points to the intervals of their key that hold them and aggregating,
    but no pair is ever formed: the running totals of a key's points are read off at both ends of
    each interval and subtracted. The cost is linear however many intervals overlap. A null ``end``
    is an open interval; intervals without points count 0.
    """
    open_end = F.lit(OPEN_END).cast("timestamp")
    ends = F.array(
        F.struct(F.col(start).alias(_AT), F.lit(-1).alias("_sign")),
        F.struct(F.coalesce(end, open_end).alias(_AT), F.lit(1).alias("_sign")),
    )
    valid = intervals.filter(F.coalesce(F.col(start) < F.col(end), F.lit(True)))
    # at equal times an interval end is read before the points, so points at `end` stay outside
    probes = valid.select(on, *[c for c in by if c != on], F.inline(ends), F.lit(0).alias(_SIDE))
    marks = points.select(on, F.col(ts).alias(_AT), F.lit(1).alias(_SIDE), *measures)
    moves = probes.unionByName(marks, allowMissingColumns=True)
    sums = {f"_{m}": F.coalesce(F.col(m), F.lit(0)).cast("bigint") for m in measures}
    upto = over_history(
        moves, on, [_AT, _SIDE], lambda w: {f"_upto_{m}": running(f"_{m}", w) for m in measures}, totals=sums
    )
    return (
        upto.filter(F.col(_SIDE) == 0)
        .groupBy(*by)
        .agg(*[F.sum(F.col("_sign") * F.col(f"_upto_{m}")).alias(m) for m in measures])
    )


def salted_join(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Equi-join of a large left side that may have hot keys.

    Rows of hot left keys are spread over as many salts as they have segments and the few right rows
    of those keys are repeated per salt; all other keys keep salt 0 on both sides. ``how`` may be
    inner, left, left_semi or left_anti: all of these are safe because each left row still meets
    every right row of its key exactly once.
    """
    found = hot_targets(left, on)
    if found is None:
        return left.join(right, on, how)
    hot, _, _ = found
    schema = StructType([StructField(on, left.schema[on].dataType), StructField("_salts", LongType())])
    salts = F.broadcast(small_table(left.sparkSession, hot, schema))  # at most about maxSplits rows
    width = F.coalesce("_salts", F.lit(1))
    spread = left.join(salts, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*left.columns), width)).drop("_salts")
    copies = (
        right.join(salts, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), width - 1)))
        .drop("_salts")
    )
    return spread.join(copies, [on, "_salt"], how).drop("_salt")
