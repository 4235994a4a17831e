"""Ordered analysis per device: previous and next rows, running totals, sliding and rolling frames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from fleetscope.operators.hot import SEG, Segments, hot_segments, with_segment

_HALO, _ROW = "_halo", "_row"
DETECT = object()


def history(key: str, order: list[str]) -> WindowSpec:
    return Window.partitionBy(key).orderBy(*order)


def running(col: str, w: WindowSpec) -> Column:
    return F.sum(col).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def over_history(
    df: DataFrame,
    key: str,
    order: list[str],
    build: Callable[[WindowSpec], dict[str, Column]],
    back: int = 0,
    ahead: int = 0,
    totals: dict[str, Column] | None = None,
    hot: Segments | None | object = DETECT,
) -> DataFrame:
    """Add window columns over each key's ordered history, exact also for keys of any size.

    ``build`` gets the window and returns the new columns. ``back`` and ``ahead`` say how many rows
    before and after the current one its frames reach. ``totals`` are per-row numbers available to
    ``build`` by name for unbounded running sums; they are dropped from the result. ``order`` starts
    with the time column and has to be total, or at least total within equal times. ``hot`` hands
    in segments already found for the same keys, so they are not looked for again.
    """
    totals = totals or {}
    hot = hot_segments(df, key, order[0]) if hot is DETECT else hot
    rows = df.withColumns(totals) if totals else df
    if hot is None:
        return rows.withColumns(build(history(key, order))).drop(*totals)

    cut = with_segment(rows, order[0], hot, only_hot=True)
    halo = _halo(cut, key, order, max(back, 1 if totals else 0), ahead, list(totals))
    rows = with_segment(rows, order[0], hot).withColumn(_HALO, F.lit(False))
    w = Window.partitionBy(key, SEG).orderBy(*order)
    out = rows.unionByName(halo).withColumns(build(w))
    return out.filter(~F.col(_HALO)).drop(SEG, _HALO, *totals)


def _edge_rows(rows: DataFrame, key: str, order: list[str], n: int, row: Column, last: bool) -> DataFrame:
    """The first or last ``n`` rows of each segment as one sorted array (the rank limit runs map-side)."""
    direction = [F.desc(c) if last else F.asc(c) for c in order]
    ranked = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(key, SEG).orderBy(*direction)))
    return (
        ranked.filter(F.col("_rn") <= n)
        .groupBy(key, SEG)
        .agg(F.sort_array(F.collect_list(row)).alias(_ROW))
    )


def _halo(rows: DataFrame, key: str, order: list[str], back: int, ahead: int, totals: list[str]) -> DataFrame:
    """Copies of the rows next to each cut, tagged with the segment on the other side of it.

    The earliest copy before a segment also carries the sums of all segments before, so running
    totals continue where the previous segment ended.
    """
    plain = [c for c in rows.columns if c not in (key, SEG, *totals)]
    row = F.struct(*order, *[c for c in plain if c not in order])
    lane = Window.partitionBy(key).orderBy(SEG)
    parts = []
    if back:
        near = _edge_rows(rows, key, order, back, row, last=True)
        if totals:
            before_all = lane.rowsBetween(Window.unboundedPreceding, -1)
            sums = rows.groupBy(key, SEG).agg(*[F.sum(t).alias(t) for t in totals])
            near = near.join(sums, [key, SEG]).withColumns(
                {t: F.coalesce(F.sum(t).over(before_all), F.lit(0)) for t in totals}
            )
        near = near.withColumn("_near", _flat([F.lag(_ROW, i).over(lane) for i in range(back, 0, -1)]))
        nearest = F.slice("_near", F.greatest(F.size("_near") - back + 1, F.lit(1)), back)
        near = near.select(key, SEG, *totals, F.posexplode(nearest).alias("_i", _ROW))
        first = F.col("_i") == 0
        parts.append(
            near.select(
                key, SEG, f"{_ROW}.*", *[F.when(first, F.col(t)).otherwise(F.lit(0)).alias(t) for t in totals]
            )
        )
    if ahead:
        heads = _edge_rows(rows, key, order, ahead, row, last=False)
        near = heads.withColumn("_near", _flat([F.lead(_ROW, i).over(lane) for i in range(1, ahead + 1)]))
        near = near.select(key, SEG, F.explode(F.slice("_near", 1, ahead)).alias(_ROW))
        parts.append(near.select(key, SEG, f"{_ROW}.*", *[F.lit(0).alias(t) for t in totals]))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.withColumn(_HALO, F.lit(True))


def _flat(arrays: list[Column]) -> Column:
    return F.flatten(F.filter(F.array(*arrays), lambda a: a.isNotNull()))


def rolling_count(df: DataFrame, key: str, seconds: str, span: int, out: str, weight: Column | None = None) -> DataFrame:
    """Sum of ``weight`` (default 1) over the rows of the key within the last ``span`` seconds.

    ``seconds`` is a whole-second column; both ends of the frame count, as do rows at the same time.
    Each row enters at its own time and leaves right after ``span`` seconds, so the answer is a
    running total over entries and exits: linear in the rows however many fall into one frame.
    """
    cols = df.columns
    weight = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    entered = df.withColumns({"_at": F.col(seconds).cast("bigint") * 2, "_w": weight, "_probe": F.lit(True)})
    left = entered.withColumns({"_at": F.col("_at") + 2 * span + 1, "_w": -F.col("_w"), "_probe": F.lit(False)})
    moves = entered.unionByName(left.filter(F.col("_w") != 0))

    def total(w: WindowSpec) -> dict[str, Column]:
        return {out: F.sum("_net").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))}

    summed = over_history(moves, key, ["_at"], total, totals={"_net": F.col("_w")})
    return summed.filter("_probe").select(*cols, out)


def latest_per_key(df: DataFrame, key: str, order: list[str], cols: list[str]) -> DataFrame:
    """The last row of each key; an aggregate, so each map task sends one row per key at most."""
    last = F.max_by(F.struct(*cols), F.struct(*order)).alias("_last")
    return df.groupBy(key).agg(last).select(key, "_last.*")


def dense_ranks(df: DataFrame, value: str) -> DataFrame:
    """Add descending ``rank`` and ``dense_rank`` of ``value`` over the whole table.

    The global window sees only the distinct values with their frequencies. Their number d is small:
    for counts that add up to N rows, d distinct counts sum to at least d(d+1)/2, so d < sqrt(2N).
    Whether the ranks are broadcast is left to their size.
    """
    w = Window.orderBy(F.desc(value))
    ranks = (
        df.groupBy(value)
        .agg(F.count("*").alias("_n"))
        .select(
            value,
            (F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1).alias("rank"),
            F.row_number().over(w).cast("bigint").alias("dense_rank"),
        )
    )
    return df.join(ranks, value)


def sessions(df: DataFrame, key: str, order: list[str], gap: str, measures: dict[str, Column]) -> DataFrame:
    """Runs of a key's rows that follow each other in less than ``gap``: session_start, session_end and ``measures``.

    The same as grouping by ``session_window``, which puts all rows of a key into one task. Here a row is
    marked as the first of a session when it comes ``gap`` or more after the one before, and the running
    total of marks numbers the sessions, both exact across the cuts of a hot key. A session's rows are
    then aggregated on the map side. Rows without a time belong to no session.
    """
    ts = order[0]
    length = F.expr(f"INTERVAL {gap}")
    timed = df.filter(F.col(ts).isNotNull())
    marked = over_history(timed, key, order, lambda w: {"_was": F.lag(ts).over(w)}, back=1)
    first = F.when(F.col("_was").isNull() | (F.col(ts) >= F.col("_was") + length), 1).otherwise(0).cast("bigint")
    numbered = over_history(
        marked, key, order, lambda w: {"_session": running("_first", w)}, totals={"_first": first}
    )
    found = [F.min(ts).alias("session_start"), (F.max(ts) + length).alias("session_end")]
    found += [value.alias(name) for name, value in measures.items()]
    return numbered.groupBy(key, "_session").agg(*found).drop("_session")
