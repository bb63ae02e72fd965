"""One pass over rows in a global order, without one task for all of them.

Rows are range-partitioned on the whole order and sorted inside each range: one
shuffle, whatever the size of a key, a day or a run of equal rows (a row number
breaks the last ties, so that a range may end between equal rows).  A task
streams over its range in Arrow batches and adds columns that depend on the rows
before; the result is written once, with the number of the range and the place in it.
What a range needs from the ranges before it is then one row a range: the last row
of a range is found by an aggregate over the written table, the ranges are combined in a
frame of as many rows as there are ranges, and that frame is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stockroom.sources.sinks import materialize

RANGE, PLACE, ROW = "_range", "_place", "_row"

# (batch, row before it or None) -> the added columns
Step = Callable[[pa.RecordBatch, "pa.RecordBatch | None"], list[pa.Array]]


def scan_in_order(
    df: DataFrame, order: Sequence[Column], step: Callable[[], Step], added: Sequence[StructField], name: str,
    number_rows: bool = True,
) -> DataFrame:
    """``df`` with the columns that ``step`` adds, ``_range`` and ``_place`` (from 0
    in a range), as a written table.

    ``step()`` makes the state of one range: a function of a batch and of the row
    before it in the range.  It may return fewer rows by a first
    boolean array (rows that stay); ``added`` names the other arrays.  With
    ``number_rows`` equal rows may fall into different ranges; without it, rows that
    are equal in the whole order meet in one range.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = df.withColumn(ROW, F.monotonically_increasing_id()) if number_rows else df
    full = [*order, F.col(ROW)] if number_rows else list(order)
    schema = StructType([*df.schema.fields, *added, StructField(RANGE, LongType()), StructField(PLACE, LongType())])
    width = len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, place, before, advance = TaskContext.get().partitionId(), 0, None, step()
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.select(list(range(width)))
            stays, *more = advance(batch, before)
            before = batch.slice(batch.num_rows - 1)
            columns = [c.filter(stays) if stays is not None else c for c in [*batch.columns, *more]]
            n = len(columns[0])
            columns += [pa.array([number] * n, pa.int64()), pa.array(range(place, place + n), pa.int64())]
            place += n
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    ordered = numbered.repartitionByRange(ranges, *full).sortWithinPartitions(*full)
    return materialize(ordered.mapInArrow(run, schema), name)


def range_ends(scanned: DataFrame, row: Column, first: bool = False) -> DataFrame:
    """(_range, end): ``row`` (a struct) at the last (or first) place of each range; one row a range."""
    pick = F.min_by if first else F.max_by
    return scanned.groupBy(RANGE).agg(pick(row, F.col(PLACE)).alias("end"))


def shifted(now: pa.Array, before: pa.Array | None) -> pa.Array:
    """Each row's value in the row before it (null before the first row of a range)."""
    head = before.slice(len(before) - 1) if before is not None else pa.nulls(1, now.type)
    return pa.concat_arrays([head, now.slice(0, len(now) - 1)])


def same_as_before(batch: pa.RecordBatch, before: pa.RecordBatch | None, columns: Sequence[str]) -> pa.Array:
    """Whether a row equals the row before it in ``columns`` (null equals null); false for the first of a range."""
    out = None
    for c in columns:
        now = batch.column(c)
        old = shifted(now, before.column(c) if before is not None else None)
        if pa.types.is_struct(now.type):
            raise TypeError(f"{c}: compare the fields of a struct one by one")
        same = pc.or_(pc.fill_null(pc.equal(now, old), False), pc.and_(now.is_null(), old.is_null()))
        out = same if out is None else pc.and_(out, same)
    if before is None:
        out = pa.concat_arrays([pa.array([False]), out.slice(1)])
    return out
