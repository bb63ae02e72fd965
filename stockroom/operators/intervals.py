"""Interval operators: validity intervals from neighbouring rows, as-of range
join, and the spread of intervals over a date spine.

The source computes its intervals with ``LEAD`` over an *un-partitioned*
window, which Spark can only run in a single task.  The functions here give the
same rows in a distributed way; the literal forms they are tested against are
in ``tests/literal_forms.py``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField

from stockroom.operators.ordered import PLACE, RANGE, range_ends, same_as_before, scan_in_order, shifted


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- W6
def month_successors(rows: DataFrame, month: str, key: str) -> DataFrame:
    """(_m, _last_key, _next_month): per month its smallest key (null if it has a
    null key, which sorts last in key DESC NULLS FIRST only when it is alone) and
    the next older month.

    The minimum is aggregated partially, so every map task sends one row per
    month; only that frame, bounded by the calendar, is ordered as a whole.
    """
    months = rows.groupBy(F.col(month).alias("_m")).agg(F.min(key).alias("_last_key"))
    return months.withColumn("_next_month", F.lead("_m").over(Window.orderBy(F.col("_m").desc_nulls_first())))


def lead_month(
    df: DataFrame, month: str, key: str, out: str, successors: DataFrame | None = None, boundary: str = "global"
) -> DataFrame:
    """``LEAD(month) OVER (ORDER BY month DESC, key DESC)`` for rows unique on (month, key);
    with ``boundary="per_key"`` the same ``PARTITION BY key`` (a key has at most
    one row per calendar month).

    In that order the next row of any key but the smallest of its month is in
    the same month; the smallest key's next row opens the next older month.
    ``successors`` (``month_successors`` of all rows) lets ``df`` hold a part of
    the keys only.
    """
    if boundary == "per_key":
        return df.withColumn(out, F.lead(month).over(Window.partitionBy(key).orderBy(F.col(month).desc_nulls_first())))
    months = successors if successors is not None else month_successors(df, month, key)
    # one row per calendar month: a proven-small side, broadcast to every task
    joined = df.join(F.broadcast(months), df[month].eqNullSafe(F.col("_m")), "left")
    is_last = F.col(key).eqNullSafe(F.col("_last_key"))
    return joined.withColumn(out, F.when(is_last, F.col("_next_month")).otherwise(F.col(month))).drop(
        "_m", "_last_key", "_next_month"
    )


def start_after_previous(prev: str | Column, end: str | Column) -> Column:
    """Cost interval start: ``CASE WHEN prev >= end THEN prev WHEN prev < end THEN prev + 1 END``."""
    p, e = _c(prev), _c(end)
    return F.when(p >= e, p).when(p < e, F.date_add(p, 1))


def record_start(prev: str | Column, record: str | Column) -> Column:
    """Inventory interval start: ``CASE WHEN prev >= d THEN d WHEN prev < d THEN prev + 1 END``."""
    p, d = _c(prev), _c(record)
    return F.when(p >= d, d).when(p < d, F.date_add(p, 1))


# ---------------------------------------------------------------- W5
def lead_across_groups(
    df: DataFrame, group: str | Sequence[str], date: str, tie_breakers: Sequence[str], out: str, boundary: str = "global"
) -> DataFrame:
    """``LEAD(date) OVER (ORDER BY group, date DESC, ties...)`` over the whole frame;
    with ``boundary="per_key"`` the same ``PARTITION BY group``: null after a
    group's last row.

    The rows are passed in the opposite order (``ordered.scan_in_order``), where the
    next row is the one before: one shuffle of the rows, and one row per range for the
    first row of the range after it.
    """
    groups = [group] if isinstance(group, str) else list(group)
    order = [
        *[F.col(g).desc_nulls_first() for g in groups], F.col(date).asc_nulls_last(),
        *[F.col(t).desc_nulls_first() for t in tie_breakers],
    ]
    per_key = boundary == "per_key"

    def step():
        def advance(batch, before):
            lead = shifted(batch.column(date), before.column(date) if before is not None else None)
            if per_key:
                lead = pc.if_else(same_as_before(batch, before, groups), lead, pa.nulls(len(lead), lead.type))
            return None, lead

        return advance

    led = scan_in_order(df, order, step, [StructField(out, df.schema[date].dataType)], "interval-order")
    row = F.struct(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col(date).alias("_date"))
    # as many rows as there are ranges
    ends = range_ends(led, row).withColumn("_before", F.lag("end").over(Window.orderBy(RANGE))).drop("end")
    joined = led.join(F.broadcast(ends), RANGE, "left")
    first = F.col("_before._date")
    if per_key:
        same = [F.col(g).eqNullSafe(F.col(f"_before._g{i}")) for i, g in enumerate(groups)]
        first = F.when(reduce(lambda x, y: x & y, same), first)
    return joined.withColumn(out, F.when(F.col(PLACE) == 0, first).otherwise(F.col(out))).select(*df.columns, out)


# ---------------------------------------------------------------- J6
def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    point: str,
    lo: str,
    hi: str,
    how: str = "inner",
) -> DataFrame:
    """Join on ``on`` plus ``lo <= point <= hi``.

    Each interval is expanded to the months it touches, so the month is an
    equality key and a row meets only the intervals of its own month; the range
    itself is checked on those.
    """
    right = right.where(F.col(lo) <= F.col(hi)).withColumn(
        "_month", F.explode(F.sequence(F.trunc(lo, "month"), F.trunc(hi, "month"), F.expr("INTERVAL 1 MONTH")))
    )
    cond = [left[a] == right[b] for a, b in on]
    cond += [F.trunc(left[point], "month") == right["_month"], left[point] <= right[hi], left[point] >= right[lo]]
    return left.join(right, cond, how).drop("_month")


def asof_carry(
    points: DataFrame, intervals: DataFrame, on: Sequence[tuple[str, str]], point: str, lo: str, hi: str, how: str = "inner"
) -> DataFrame:
    """``asof_join`` for intervals that do not overlap within a key, of any length.

    Points and interval starts are passed in (key, time) order
    (``ordered.scan_in_order``), and each point takes the interval that started last before
    it, if that one reaches it.  As many rows are shuffled as there are points and
    intervals; a hot key is cut into ranges.  Two overlapping intervals of a key that
    follow each other in a range are an error.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    usable = intervals.where(F.col(lo).isNotNull() & (F.col(lo) <= F.col(hi)))
    for _, b in on:
        usable = usable.where(F.col(b).isNotNull())
    held, row = F.struct(*intervals.columns).alias("_held"), F.struct(*points.columns).alias("_point")
    starts = usable.select(
        *[F.col(b).alias(k) for k, (_, b) in zip(keys, on, strict=True)], F.col(lo).alias("_at"), F.lit(0).alias("_kind"), held
    )
    marks = points.select(
        *[F.col(a).alias(k) for k, (a, _) in zip(keys, on, strict=True)], F.col(point).alias("_at"), F.lit(1).alias("_kind"), row
    )
    both = starts.unionByName(marks, allowMissingColumns=True)
    order = [*[F.col(k).asc_nulls_first() for k in keys], F.col("_at").asc_nulls_first(), F.col("_kind").asc()]
    kind = StructField("_found", both.schema["_held"].dataType)

    def step():
        state = {"carry": None, "head": True}

        def advance(batch, before):
            n = batch.num_rows
            same = np.asarray(same_as_before(batch, before, keys))
            start = np.asarray(batch.column("_kind")) == 0
            rows = np.arange(n)
            # the last start at or before each row, and the row where its key begins (-1: an earlier batch)
            last = np.maximum.accumulate(np.where(start, rows, -1))
            begin = np.maximum.accumulate(np.where(same, -1, rows))
            carry = state["carry"] if state["carry"] is not None else pa.nulls(1, batch.column("_held").type)
            pool = pa.concat_arrays([carry, batch.column("_held")])
            at = np.where(last >= np.maximum(begin, 0), last + 1, np.where(begin < 0, 0, -1))
            found = pool.take(pa.array(at, pa.int64(), mask=at < 0))
            earlier = found.slice(0, n - 1) if n > 1 else found.slice(0, 0)
            earlier = pa.concat_arrays([carry, earlier])
            clash = pc.greater_equal(earlier.field(hi), batch.column("_held").field(lo))
            if pc.any(pc.and_(pa.array(start & same), pc.fill_null(pc.and_(clash, earlier.is_valid()), False))).as_py():
                raise ValueError("intervals of one key overlap")
            # rows of the key that the range begins with may continue the range before
            head = state["head"] & (begin <= 0 if before is None else begin < 0)
            state["carry"], state["head"] = found.slice(n - 1), bool(head[-1])
            return None, found, pa.array(head)

        return advance

    scanned = scan_in_order(both, order, step, [kind, StructField("_head", BooleanType())], "asof-order")
    tails = range_ends(scanned, F.struct(*keys, F.col("_found").alias("_v"))).select(RANGE, "end.*")
    heads = range_ends(scanned, F.struct(*keys), first=True).select(RANGE, "end.*")
    ends = tails.withColumn("_side", F.lit(1)).unionByName(heads.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    so_far = Window.partitionBy(*keys).orderBy(RANGE, "_side").rowsBetween(Window.unboundedPreceding, -1)
    brought = ends.withColumn("_brought", F.last("_v", ignorenulls=True).over(so_far)).where("_side = 0").select(RANGE, "_brought")
    rows = scanned.where("_kind = 1").join(F.broadcast(brought), RANGE, "left")
    found = F.coalesce("_found", F.when(F.col("_head"), F.col("_brought")))
    rows = rows.withColumn("_found", found)
    reached = F.col("_at") <= F.col(f"_found.{hi}")
    if how == "inner":
        return rows.where(reached).select("_point.*", "_found.*")
    return rows.withColumn("_found", F.when(reached, F.col("_found"))).select("_point.*", "_found.*")


# ---------------------------------------------------------------- J7
def clip(intervals: DataFrame, lo: str, hi: str, bounds: tuple[dt.date, dt.date]) -> DataFrame:
    """Intervals that touch ``bounds``, with ``_lo`` and ``_hi`` cut to them."""
    # greatest/least skip nulls, so intervals with a null end (which match no
    # day) are dropped first
    return (
        intervals.where(F.col(lo).isNotNull() & F.col(hi).isNotNull())
        .withColumn("_lo", F.greatest(F.col(lo), F.lit(bounds[0])))
        .withColumn("_hi", F.least(F.col(hi), F.lit(bounds[1])))
        .where(F.col("_lo") <= F.col("_hi"))
    )


def uncovered_days(spine: DataFrame, clipped: DataFrame, day: str) -> DataFrame:
    """Spine rows of the days that no clipped interval covers.

    Intervals become +1/-1 edges summed per day (at most one row per spine day
    and map task) and a running total over the spine, whose size is fixed by
    its definition.
    """
    edges = clipped.select(F.explode(F.array(
        F.struct(F.col("_lo").alias("_e"), F.lit(1).alias("_delta")),
        F.struct(F.date_add("_hi", 1).alias("_e"), F.lit(-1).alias("_delta")),
    )).alias("_edge")).groupBy(F.col("_edge._e").alias("_e")).agg(F.sum("_edge._delta").alias("_delta"))
    running = Window.orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
    free = (
        spine.select(F.col(day).alias("_d")).join(edges, F.col("_d") == F.col("_e"), "left")
        .withColumn("_open", F.sum(F.coalesce("_delta", F.lit(0))).over(running))
        .where(F.col("_open") == 0).select("_d")
    )
    return spine.join(F.broadcast(free), spine[day] == F.col("_d"), "left_semi")


def dealt(intervals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rows dealt to as many tasks as the session's shuffles have, one after the
    other or, with ``by``, by those columns."""
    tasks = int(intervals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return intervals.repartition(tasks, *by)


def spread_over_spine(
    spine: DataFrame, intervals: DataFrame, day: str, lo: str, hi: str, bounds: tuple[dt.date, dt.date]
) -> DataFrame:
    """``spine LEFT JOIN intervals ON day BETWEEN lo AND hi``, with cost proportional to the output.

    Each interval, clipped to the spine's first and last day (``bounds``),
    becomes one row per day; those rows meet the spine in an equi-join on the
    day, with the spine broadcast (its size is fixed by its definition).  Spine
    days that no interval covers are added with null interval columns.

    Long intervals often lie side by side in the input, in a few files, and make most
    of the output: the intervals are dealt out before they are expanded.
    """
    clipped = clip(intervals, lo, hi, bounds)
    days = dealt(clipped).withColumn("_day", F.explode(F.sequence("_lo", "_hi"))).drop("_lo", "_hi")
    matched = days.join(F.broadcast(spine), days["_day"] == spine[day], "inner").drop("_day")
    return matched.unionByName(uncovered_days(spine, clipped, day), allowMissingColumns=True)


# ---------------------------------------------------------------- J7, weekly form
def spread_over_weeks(
    spine: DataFrame,
    intervals: DataFrame,
    day: str,
    lo: str,
    hi: str,
    bounds: tuple[dt.date, dt.date],
    piece_keys: Sequence[Column],
    weight: str = "_days",
    by: Sequence[str] = (),
    attach: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """``spread_over_spine`` pre-aggregated for reporting by week.

    ``piece_keys`` are spine attributes, one of them the week ending; days
    sharing all of them form a "piece" (the days of one week inside one month
    and year).  Instead of one row per covered day, each interval gives one row
    per piece it touches, with the number of covered days in ``weight``; spine
    days that no interval covers give one row each (weight 1, null interval
    columns).  Sums over days are then ``sum(x * weight)``.

    The intervals and the uncovered days are dealt out before they are expanded; with
    ``by`` by those columns, so that sums grouped by them and the pieces need no
    shuffle of the expanded rows.  ``attach`` joins columns to the intervals before that.
    """
    clipped = clip(intervals, lo, hi, bounds)
    keyed = spine.select(F.col(day).alias("_sd"), *piece_keys)
    names = [c for c in keyed.columns if c != "_sd"]
    # a piece lies inside one Monday..Sunday week, so its week end is the
    # week end of its first day
    pieces = keyed.groupBy(*names).agg(F.min("_sd").alias("_p_lo"), F.max("_sd").alias("_p_hi"))
    pieces = pieces.withColumn("_p_week", F.date_add(F.trunc("_p_lo", "week"), 6))
    # an uncovered day is an interval of one day without columns
    free = uncovered_days(keyed, clipped, "_sd").select(F.col("_sd").alias("_lo"), F.col("_sd").alias("_hi"))
    weeks = dealt(attach(clipped).unionByName(free, allowMissingColumns=True), by).withColumn(
        "_week",
        F.explode(F.sequence(F.date_add(F.trunc("_lo", "week"), 6), F.date_add(F.trunc("_hi", "week"), 6),
                             F.expr("INTERVAL 7 DAYS"))),
    )
    touched = weeks.join(F.broadcast(pieces), weeks["_week"] == pieces["_p_week"])
    covered_days = F.datediff(F.least("_hi", "_p_hi"), F.greatest("_lo", "_p_lo")) + 1
    touched = touched.withColumn(weight, covered_days).where(F.col(weight) > 0)
    return touched.drop("_lo", "_hi", "_week", "_p_lo", "_p_hi", "_p_week")
