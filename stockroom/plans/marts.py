"""Weekly reporting views over the facts and dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockroom.functions import week_ending
from stockroom.operators.intervals import clip, lead_across_groups, record_start, spread_over_spine, spread_over_weeks
from stockroom.plans.schemas import POS

# Columns that order rows of one item on one day, so that the interval lead is
# deterministic (the source leaves ties to chance).
INTERVAL_TIE_BREAKERS = ["locationid", "source", "sku", "categoryid", "qoh", "backorder", "cost"]


def inventory_intervals(inventory: DataFrame, boundary: str = "global") -> DataFrame:
    """Each stock record covers ``(previous record date, record date]``.

    The previous record date is the next row in (item, date DESC) order over
    the whole fact, as in the source: at an item's oldest record it is the
    newest date of the next item.  ``boundary="per_key"`` keeps it within the
    item and location.
    """
    if boundary == "per_key":
        led = lead_across_groups(
            inventory, ["itemuuid", "locationid"], "date", INTERVAL_TIE_BREAKERS[1:], "previousrecorddate", "per_key"
        )
    else:
        led = lead_across_groups(inventory, "itemuuid", "date", INTERVAL_TIE_BREAKERS, "previousrecorddate")
    return led.select(
        "date", "sku", "itemuuid", "qoh", "backorder", "cost", "locationid", "categoryid", "source",
        "previousrecorddate", record_start("previousrecorddate", "date").alias("startrecorddate"),
    )


def _interval_cols(intervals: DataFrame) -> DataFrame:
    return intervals.withColumnRenamed("date", "record_date")


def inventory_on_spine(spine: DataFrame, intervals: DataFrame, bounds: tuple[dt.date, dt.date]) -> DataFrame:
    """Every spine day with every interval covering it; uncovered days once,
    with null interval columns."""
    return spread_over_spine(spine, _interval_cols(intervals), "date", "startrecorddate", "record_date", bounds)


# Columns of a record that are keys of the weekly rows.
_RECORD_KEYS = ["itemuuid", "sku", "categoryid", "source"]
_WEEKLY_KEYS = [
    "year", "weekending", "month", "month_name", "week_of_year", "itemuuid", "sku", "categoryid", "source",
    "brandname", "description", "color", "size", "attribute3", "georegion",
]
_WEEKLY_OUT = [
    "weekending", "year", "month", "month_name", "week_of_year", "sku", "itemuuid",
    "qoh_sum", "backorder_sum", "avg_cost", "categoryid", "source", "brandname", "description",
    "color", "size", "attribute3", "georegion", "inventorydollars",
]


def _with_locations(frame: DataFrame, locations: DataFrame) -> DataFrame:
    """Left join on the location; rows without one match nothing and are spread
    over tasks by their item instead of meeting in one."""
    loc = locations.where(F.col("locationid").isNotNull()).select(
        F.col("locationid").alias("_loc"), F.lit(True).alias("_has"), F.col("category").alias("georegion")
    )
    has = F.col("locationid").isNotNull()
    keyed = frame.withColumn("_lkey", F.coalesce("locationid", "itemuuid")).withColumn("_lhas", has)
    on = (keyed["_lkey"] == loc["_loc"]) & (keyed["_lhas"] == loc["_has"])
    return keyed.join(loc, on, "left").drop("_loc", "_has", "_lkey", "_lhas")


def inventory_weekly(
    spine: DataFrame,
    intervals: DataFrame,
    items: DataFrame,
    locations: DataFrame,
    bounds: tuple[dt.date, dt.date],
) -> DataFrame:
    """Stock, backorder, average cost and inventory dollars per week, item and
    location group.

    Same result as grouping the day-level spread, but equal intervals of an item,
    location and day are summed and counted first, the dimensions are joined to those
    sums, and each is expanded only to the week pieces it touches, weighted by covered
    days.  The sums are dealt by their item columns before they are expanded, so the
    weekly rows, by far the most, are grouped where they are made.  Each average is the
    sum over the count, divided with the same decimal types as ``avg`` so that
    rounding is identical.
    """
    held = clip(_interval_cols(intervals), "startrecorddate", "record_date", bounds).groupBy(
        *_RECORD_KEYS, "locationid", F.col("_lo").alias("_from"), F.col("_hi").alias("_to")
    ).agg(
        F.sum("qoh").alias("_qoh"), F.count("qoh").alias("_qoh_n"), F.sum("backorder").alias("_backorder"),
        F.sum("cost").alias("_cost"), F.count("cost").alias("_cost_n"),
    )
    it = items.select(F.col("uuid").alias("_uuid"), "brandname", "description", "color", "size", "attribute3")

    def with_dimensions(rows: DataFrame) -> DataFrame:
        joined = rows.join(it, rows["itemuuid"] == it["_uuid"], "left").drop("_uuid")
        return _with_locations(joined, locations).drop("locationid")

    piece_keys = [F.col("year"), week_ending("date").alias("weekending"), F.col("month"),
                  F.col("month_name"), F.col("week_of_year")]
    rows = spread_over_weeks(
        spine, held, "date", "_from", "_to", bounds, piece_keys, by=_RECORD_KEYS, attach=with_dimensions
    )
    w = F.col("_days")
    cost_sum = F.sum(F.col("_cost") * w).cast("decimal(16,2)")
    cost_days = F.sum(F.when(F.col("_cost_n") > 0, F.col("_cost_n") * w)).cast("decimal(20,0)")
    qoh_days = F.sum(F.when(F.col("_qoh_n") > 0, F.col("_qoh_n") * w)).cast("decimal(20,0)")
    qoh_avg = (F.sum(F.col("_qoh") * w).cast("decimal(30,0)") / qoh_days).cast("decimal(24,4)")
    agg = rows.groupBy(*_WEEKLY_KEYS).agg(
        F.sum(F.col("_qoh") * w).alias("qoh_sum"),
        F.sum(F.col("_backorder") * w).alias("backorder_sum"),
        (cost_sum / cost_days).cast("decimal(10,6)").alias("avg_cost"),
        (cost_sum * qoh_avg).alias("inventorydollars"),
    )
    return agg.select(*_WEEKLY_OUT)


_CALENDAR = ["weekending", "year", "month", "month_name", "week_of_year"]
_SALES_ITEM = ["sku", "brandname", "vendorid", "categoryid", "description", "color", "size", "attribute3"]


def on_calendar(spine: DataFrame, orders: DataFrame) -> DataFrame:
    # the calendar is at most 366 + 4 * 365 rows: broadcast to the fact's tasks
    return orders.join(F.broadcast(spine), "date")


def sales_weekly(spine: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders, quantity, dollars and average discount per week and item.

    Location and the item's source are grouping keys that are not output, so
    visible keys can repeat, as in the source.  The fact is aggregated before
    the item join (so a best-seller brings one row a week and location to it); items are
    collapsed to distinct rows with their number, by which sums grow and to
    which averages and distinct counts do not react.
    """
    # days are numbered by the calendar columns of their rows; the number stands for these until the sums are made
    days = spine.select("date", week_ending("date").alias("weekending"), *_CALENDAR[1:]).withColumn(
        "_piece", F.dense_rank().over(Window.orderBy(*_CALENDAR))
    )
    group = ["_piece", "itemuuid", "locationid", "source"]
    # a week's rows of an item and location meet once, for their sums and their orders
    sums = on_calendar(days.select("date", "_piece"), orders).repartition(*group).groupBy(*group).agg(
        F.count_distinct("orderuuid").alias("ordercount"), F.sum("qty_sold").alias("_qty"),
        F.sum("price").alias("_dollars"), F.avg("discount").alias("avgpercentdiscount"),
    )
    return with_items(sums, items, days.select("_piece", *_CALENDAR).distinct())


# Which part of a hot item, by week, location and source, a row belongs to; -1 for other items.
APART = "_locationid_part"


def with_items(
    sums: DataFrame, items: DataFrame, pieces: DataFrame | None = None, hot: tuple[Sequence[str], int] | None = None
) -> DataFrame:
    """Sums per week and item joined to the items' rows; with ``pieces`` the calendar
    columns are those of the sum's ``_piece``.  With ``hot``, some items and a number of parts, the sums
    lie by item and ``APART``, and a hot item's rows go to each of its parts."""
    # item rows that differ in their source only stay apart, as grouping keys
    it = items.groupBy("uuid", *_SALES_ITEM, F.col("source").alias("item_source")).agg(F.count(F.lit(1)).alias("_n"))
    on = sums["itemuuid"] == it["uuid"]
    if hot is not None:
        chosen, parts = hot
        places = F.when(F.col("uuid").isin(list(chosen)), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(-1)))
        it = it.withColumn("_of", F.explode(places))
        on = (sums["itemuuid"] == it["uuid"]) & (sums[APART] == it["_of"])
    j = sums.join(it, on, "left")
    if pieces is not None:
        j = j.join(F.broadcast(pieces), "_piece")
    n = F.coalesce("_n", F.lit(1))
    return j.select(
        "weekending", "year", "month", "month_name", "week_of_year", "itemuuid", "ordercount",
        (F.col("_qty") * n).alias("qtysold"), (F.col("_dollars") * n).cast("decimal(20,2)").alias("salesdollars"),
        "avgpercentdiscount", "source", "sku", "uuid", "brandname",
        "vendorid", "categoryid", "description", "color", "size", "attribute3",
    )


def discounted_sales_by_item(spine: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Quantity, dollars and average discount of discounted sales per item and source."""
    sums = on_calendar(spine, orders.where(F.col("discount") > 0)).groupBy("itemuuid", "source").agg(
        F.sum("qty_sold").alias("_qty"), F.sum("price").alias("_dollars"), F.avg("discount").alias("avgpercentdiscount"),
    )
    it = items.groupBy("uuid").agg(F.count(F.lit(1)).alias("_n"))
    n = F.coalesce("_n", F.lit(1))
    return sums.join(it, sums["itemuuid"] == it["uuid"], "left").select(
        "itemuuid", (F.col("_qty") * n).alias("qtysold"), (F.col("_dollars") * n).cast("decimal(20,2)").alias("salesdollars"),
        "avgpercentdiscount", "source",
    )


def view_lookup_distinct(sales_view: DataFrame, source: str = POS) -> DataFrame:
    """Distinct (source, item, average discount) of the weekly sales view for one source."""
    return (
        sales_view.where(F.col("source") == source)
        .select("source", "itemuuid", "avgpercentdiscount")
        .distinct()
    )
