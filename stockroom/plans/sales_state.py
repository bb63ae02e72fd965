"""Weekly sales from a stored partial state, so that a new day does not recount the history.

The state holds one row per day, reporting group and order, with the sums of the
order's lines; it is partitioned by week.  Adding a day reads and writes its
week's partition and replaces the day's rows if they are there.  A week's figures read
that week's partition only: orders that span days of a week meet there, so the number of
distinct orders is exact, and no list or bitmap of a group's orders is ever held in
one place.

Rows move once on each way.  They are dealt to the files of their week before they are
summed, a week to as many as its rows need.  They are read by their item, for the sums and for the join
with the items; the rows of an item that holds many of them are dealt by their groups, and its
item rows go to all of these.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockroom.functions import week_ending
from stockroom.plans.marts import APART, on_calendar, with_items
from stockroom.sources.sinks import append_snapshot, materialize

_CALENDAR = ["weekending", "year", "month", "month_name", "week_of_year"]
_GROUP = [*_CALENDAR, "itemuuid", "locationid", "source"]
_ORDER = ["itemuuid", "locationid", "source", "orderuuid"]
# Rows of a week that one task sums and writes.
WEEK_ROWS = 1 << 20
# Items looked at as hot, and the most parts that the rows of one are dealt to.
HOT_ITEMS, HOT_PARTS = 1_000, 256


def daily_orders(spine: DataFrame, orders: DataFrame, week_rows: int = WEEK_ROWS) -> DataFrame:
    """State rows of the orders' days: sums per day, group and order, dealt by week and by
    parts of a week of more than ``week_rows`` rows.  ``orders`` is read twice, once for its days only."""
    sold = orders.join(F.broadcast(spine.select("date")), "date", "left_semi").withColumn("weekending", week_ending("date"))
    parts = sold.groupBy("weekending").agg(F.ceil(F.count(F.lit(1)) / week_rows).alias("_parts"))
    dealt = sold.join(F.broadcast(parts), "weekending").withColumn("_part", F.pmod(F.xxhash64(*_ORDER), "_parts"))
    sums = dealt.repartition("weekending", "_part").groupBy("weekending", "_part", "date", *_ORDER).agg(
        F.sum("qty_sold").alias("qty"), F.sum("price").alias("dollars"), F.sum("discount").alias("discount"),
        F.count("discount").alias("discount_n"),
    )
    # the calendar's columns join the sums: they follow from the day
    return on_calendar(spine, sums).select(*_GROUP, "date", "orderuuid", "qty", "dollars", "discount", "discount_n")


def _exact_avg(total: Column, n: Column) -> Column:
    """``avg`` of whole numbers to four digits, rounded half away from zero once."""
    scaled = F.abs(total).cast("decimal(38,0)") * F.lit(20_000) + n
    digits = F.floor(scaled / (F.lit(2) * n)).cast("decimal(30,0)")
    signed = F.when(total < 0, -digits).otherwise(digits)
    return (signed * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(38,4)")


class SalesState:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, spine: DataFrame, orders: DataFrame) -> None:
        """Take in the days of ``orders``, which hold those days in full."""
        new = daily_orders(spine, orders)
        again = self._exists()
        if again:
            new = materialize(new, "sales-days")
            held = new.select("weekending", "date").distinct().collect()  # days of the calendar at most
            weeks, days = sorted({r["weekending"] for r in held}), sorted({r["date"] for r in held})
            kept = self.rows(weeks).where(~F.col("date").isin(days)).select(*new.columns)
            # written first: the same partitions are read and replaced
            new = materialize(new.unionByName(kept), "sales-weeks")
        append_snapshot(new, self.path, partition_col="weekending", dealt=not again)

    def _exists(self) -> bool:
        try:
            self.spark.read.parquet(self.path)
        except AnalysisException:
            return False
        return True

    def rows(self, weeks: list[dt.date] | None = None) -> DataFrame:
        """The state, of some weeks only: a partition filter."""
        state = self.spark.read.parquet(self.path)
        return state if weeks is None else state.where(F.col("weekending").isin(weeks))

    def weekly(self, items: DataFrame, weeks: list[dt.date] | None = None) -> DataFrame:
        """The rows of ``marts.sales_weekly``, of some weeks only."""
        state = self.rows(weeks)
        hot, parts = self._hot_items(state)
        # calendar pieces are numbered; the number stands for their columns until the sums are made
        pieces = state.select(*_CALENDAR).distinct().withColumn("_piece", F.dense_rank().over(Window.orderBy(*_CALENDAR)))
        same = [F.col(f"s.{c}").eqNullSafe(F.col(f"p.{c}")) for c in _CALENDAR]
        keyed = state.alias("s").join(F.broadcast(pieces.alias("p")), same).select("_piece", "s.*").drop(*_CALENDAR)
        group = ["_piece", "itemuuid", "locationid", "source"]
        own = F.pmod(F.xxhash64("_piece", "locationid", "source"), F.lit(parts)).cast("int")
        spread = F.col("itemuuid").isNull() | F.col("itemuuid").isin(hot)
        # an item's rows meet once, for its orders, its sums and its item rows
        dealt = keyed.withColumn(APART, F.when(spread, own).otherwise(-1)).repartition("itemuuid", APART)
        orders = dealt.groupBy(*group, APART, "orderuuid").agg(
            *[F.sum(c).alias(c) for c in ("qty", "dollars", "discount", "discount_n")]
        )
        sums = orders.groupBy(*group, APART).agg(
            F.count("orderuuid").alias("ordercount"), F.sum("qty").alias("_qty"), F.sum("dollars").alias("_dollars"),
            F.sum("discount").alias("_discount"), F.sum("discount_n").alias("_n_discount"),
        )
        some = F.col("_n_discount") > 0
        average = F.when(some, _exact_avg(F.col("_discount"), F.col("_n_discount")))
        return with_items(sums.withColumn("avgpercentdiscount", average), items, pieces, (hot, parts))

    def _hot_items(self, state: DataFrame) -> tuple[list[str], int]:
        """Items with more rows than half an average task's, as near as a sketch tells, and how many parts
        those are dealt to.  Decides where rows meet, not what comes out."""
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        seen = state.agg(
            F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(itemuuid, {HOT_ITEMS}, {10 * HOT_ITEMS})").alias("top")
        ).first()
        hot = [r["item"] for r in seen["top"] or [] if r["item"] is not None and r["count"] * 2 * tasks > seen["n"]]
        return hot, max(1, min(tasks, HOT_PARTS))
