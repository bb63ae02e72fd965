"""Latest-row-per-key and version ranking over change-log tables.

``latest_per_key`` is the newest-version filter (``ROW_NUMBER() ... = 1``).
Catalyst plans the filtered ``row_number`` as a partial ``WindowGroupLimit``
before the shuffle and a final one after it, so every map task first reduces
its rows to one per key: a key that holds a large share of all rows sends one
row per map task, not all its rows, to its reducer.

``rank_versions`` keeps every version with its rank (``ROW_NUMBER()`` selected,
not filtered).  Ranks need all rows of a key in order; it computes them
without one task per key by ranking inside ranges of the order and adding the
counts of earlier ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from stockroom.operators.ordered import PLACE, RANGE, range_ends, same_as_before, scan_in_order


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def newest_first(ts: str | Column, tie_breakers: Sequence[str | Column] = ()) -> list[Column]:
    """``ORDER BY ts DESC`` with the source's null placement (nulls first), then
    tie-breakers in the same direction so the order is total."""
    return [_c(c).desc_nulls_first() for c in (ts, *tie_breakers)]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie_breakers: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Newest row of each key; output columns ``keys + columns`` (default: all)."""
    keys = list(keys)
    payload = [c for c in (columns or df.columns) if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*newest_first(ts, tie_breakers))
    ranked = df.withColumn("_rn", F.row_number().over(w))
    return ranked.where(F.col("_rn") == 1).select(*keys, *payload)


def latest_per_key_per_day(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    day_col: str,
    tie_breakers: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Newest row of each key and calendar day of ``ts`` (``PARTITION BY k, to_date(ts)``)."""
    cols = list(columns or df.columns)
    with_day = df.withColumn(day_col, F.to_date(ts))
    return latest_per_key(with_day, [*keys, day_col], ts, tie_breakers, cols)


def rank_versions(
    df: DataFrame, keys: Sequence[str], ts: str, tie_breakers: Sequence[str] = (), rn: str = "rn", distinct: bool = False
) -> DataFrame:
    """Every row with its version number, 1 = newest: ``row_number`` over the key
    without sending all rows of a key to one task.

    Rows are ranked inside ranges of the whole order (``ordered.scan_in_order``): one
    shuffle, even for a key whose changes all have one time.  The rows of the key that a
    range begins with add the number of its rows in earlier ranges, which is a
    sum over one row a range.  ``distinct`` keeps equal rows once, in the same
    pass; keys, time and tie-breakers must then be all columns.
    """
    keys = list(keys)
    if distinct and set(df.columns) != {*keys, ts, *tie_breakers}:
        raise ValueError("distinct needs an order by all columns")
    order = [*[F.col(k).asc_nulls_first() for k in keys], *newest_first(ts, tie_breakers)]
    columns = list(df.columns)

    def step():
        state = {"rank": 0}

        def advance(batch, before):
            same = np.asarray(same_as_before(batch, before, keys))
            keep = ~np.asarray(same_as_before(batch, before, columns)) if distinct else np.ones(len(same), bool)
            count = np.cumsum(keep)
            # rows kept before the key's first row here; minus those of earlier batches for a key that goes on
            begin = np.maximum.accumulate(np.where(same, -1, np.arange(len(same))))
            base = np.where(begin < 0, -state["rank"], count[begin] - 1)
            rank = count - base
            state["rank"] = int(rank[-1])
            stays = pa.array(keep) if distinct else None
            return stays, pa.array(rank, pa.int64())

        return advance

    ranked = scan_in_order(df, order, step, [StructField("_rank", LongType())], "version-order", number_rows=not distinct)
    tails = range_ends(ranked, F.struct(*keys, "_rank")).select(RANGE, "end.*")
    heads = range_ends(ranked, F.struct(*keys), first=True).select(RANGE, "end.*", F.lit(0).cast("long").alias("_rank"))
    # per key, in the order of ranges, a range's first key before its last one: at most two rows a range
    ends = heads.withColumn("_side", F.lit(0)).unionByName(tails.withColumn("_side", F.lit(1)))
    so_far = Window.partitionBy(*keys).orderBy(RANGE, "_side").rowsBetween(Window.unboundedPreceding, -1)
    earlier = ends.withColumn("_earlier", F.coalesce(F.sum("_rank").over(so_far), F.lit(0))).where("_side = 0").select(RANGE, "_earlier")
    joined = ranked.join(F.broadcast(earlier), RANGE)
    goes_on = F.col("_rank") == F.col(PLACE) + 1  # rows of the key that the range begins with
    number = F.col("_rank") + F.when(goes_on, F.col("_earlier")).otherwise(F.lit(0))
    return joined.withColumn(rn, number.cast("int")).select(*columns, rn)
