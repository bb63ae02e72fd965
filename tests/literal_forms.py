"""The source's forms, as written: one global window, nested-loop joins, day-level
weekly aggregate.  The library's distributed forms are compared with them."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from stockroom.functions import week_ending
from stockroom.operators.dedup import newest_first
from stockroom.plans.marts import _WEEKLY_KEYS, _WEEKLY_OUT


def rank_versions_window(df, keys, ts, tie_breakers=(), rn="rn"):
    w = Window.partitionBy(*keys).orderBy(*newest_first(ts, tie_breakers))
    return df.withColumn(rn, F.row_number().over(w))


def lead_month_literal(df, month, key, out):
    """``LEAD(month) OVER (ORDER BY month DESC, key DESC)``"""
    w = Window.orderBy(F.col(month).desc_nulls_first(), F.col(key).desc_nulls_first())
    return df.withColumn(out, F.lead(month).over(w))


def lead_across_groups_literal(df, group, date, tie_breakers, out):
    """``LEAD(date) OVER (ORDER BY group, date DESC, ties...)``"""
    order = [F.col(date).desc_nulls_first(), *[F.col(t).asc_nulls_last() for t in tie_breakers]]
    return df.withColumn(out, F.lead(date).over(Window.orderBy(F.col(group).asc_nulls_last(), *order)))


def asof_join_literal(left, right, on, point, lo, hi):
    cond = [left[a] == right[b] for a, b in on]
    return left.join(right, [*cond, left[point] <= right[hi], left[point] >= right[lo]])


def spine_join_literal(spine, intervals, day, lo, hi):
    """``spine LEFT JOIN intervals ON day >= lo AND day <= hi``"""
    return spine.join(intervals, (spine[day] >= intervals[lo]) & (spine[day] <= intervals[hi]), "left")


def inventory_weekly_by_day(spine, intervals, items, locations):
    days = spine_join_literal(
        spine, intervals.withColumnRenamed("date", "record_date"), "date", "startrecorddate", "record_date"
    )
    it = items.select(F.col("uuid").alias("_uuid"), "brandname", "description", "color", "size", "attribute3")
    loc = locations.select(F.col("locationid").alias("_locid"), F.col("category").alias("georegion"))
    j = days.join(it, days["itemuuid"] == it["_uuid"], "left")
    j = j.join(loc, j["locationid"] == loc["_locid"], "left").withColumn("weekending", week_ending("date"))
    return j.groupBy(*_WEEKLY_KEYS).agg(
        F.sum("qoh").alias("qoh_sum"), F.sum("backorder").alias("backorder_sum"), F.avg("cost").alias("avg_cost"),
        (F.sum("cost") * F.avg(F.col("qoh").cast("decimal(20,0)"))).alias("inventorydollars"),
    ).select(*_WEEKLY_OUT)


def sales_weekly_by_row(spine, orders, items):
    """Join first, aggregate after, as written."""
    it = items.withColumnRenamed("source", "item_source")
    j = orders.join(spine, "date")
    j = j.join(it, j["itemuuid"] == it["uuid"], "left")
    attrs = ["sku", "uuid", "brandname", "vendorid", "categoryid", "description", "color", "size", "attribute3"]
    agg = j.groupBy(
        week_ending("date").alias("weekending"), "year", "month", "month_name", "week_of_year", "itemuuid", "locationid",
        "source", "item_source", *attrs,
    ).agg(
        F.count_distinct("orderuuid").alias("ordercount"), F.sum("qty_sold").alias("qtysold"),
        F.sum("price").alias("salesdollars"), F.avg("discount").alias("avgpercentdiscount"),
    )
    by_item = j.where("discount > 0").groupBy("itemuuid", "source").agg(
        F.sum("qty_sold").alias("qtysold"), F.sum("price").alias("salesdollars"),
        F.avg("discount").alias("avgpercentdiscount"),
    )
    return agg.drop("locationid", "item_source"), by_item
