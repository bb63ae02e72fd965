"""Order fact: point-of-sale orders and web-shop orders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.functions import ITEM_UUID_SEP, as_text, item_uuid, percent
from stockroom.operators.conform import union_conformed
from stockroom.operators.dedup import latest_per_key, rank_versions
from stockroom.plans.schemas import ORDER_FACT, POS, SHOP
from stockroom.sources.fixtures import CHANGE_ORDER, Inputs

# The source keeps web-shop orders from this day on.
MIN_ORDER_DATE = dt.date(2020, 1, 1)
# Order states kept (active, not cancelled).
ACCEPTED_STATUSES = (1, 2, 3)


def pos_orders_latest(inp: Inputs) -> DataFrame:
    return latest_per_key(inp.pos_order_history, ["id"], "updated_time", CHANGE_ORDER)


def pos_order_lines_latest(inp: Inputs) -> DataFrame:
    """Newest version of each order line (key: line id and order id)."""
    return latest_per_key(
        inp.pos_order_line_history, ["id", "order_id"], "updated_time", CHANGE_ORDER,
        ["updated_time", "item_id", "total", "price", "original_price", "quantity"],
    )


def pos_orders(inp: Inputs, line_key: str = "order_id") -> DataFrame:
    """Newest orders joined with their newest lines, discount as a percent.

    ``line_key`` is the line column matched to the order id: ``order_id``, or
    ``id`` for the source's literal join on the line's own id.
    """
    o = pos_orders_latest(inp).select("id", "shop_id", "ordered_date", "discount")
    ln = pos_order_lines_latest(inp).select(
        F.col(line_key).alias("_lkey"), "item_id", "price", "original_price", "quantity", "total"
    )
    j = o.join(ln, o["id"] == ln["_lkey"])
    return j.select(
        "id", "shop_id", "ordered_date", "item_id", "price", "original_price",
        percent("discount").alias("discount"), "quantity", "total",
    )


def shop_orders(
    inp: Inputs,
    min_order_date: dt.date = MIN_ORDER_DATE,
    statuses: Sequence[int] = ACCEPTED_STATUSES,
) -> DataFrame:
    o = inp.shop_orders.where(
        (F.col("order_date") >= F.lit(dt.datetime.combine(min_order_date, dt.time())).cast("timestamp_ntz"))
        & F.col("order_status").isin(list(statuses))
    )
    op = inp.shop_order_lines
    j = o.join(op, o["order_id"] == op["orders_prods_id"])
    return j.select(
        "order_id", "orders_prods_id", "order_date", "backorder_date", "prod_id", "option_id",
        "quantity", "discount_percent", "tax", "total_prod_price", "order_status", "site_id", "returned",
    )


def order_fact(
    inp: Inputs,
    min_order_date: dt.date = MIN_ORDER_DATE,
    statuses: Sequence[int] = ACCEPTED_STATUSES,
    line_key: str = "order_id",
    sep: str = ITEM_UUID_SEP,
) -> DataFrame:
    shop = shop_orders(inp, min_order_date, statuses).select(
        F.to_date("order_date"),
        item_uuid(SHOP, "prod_id", "option_id", sep=sep),
        as_text("order_id"),
        "quantity", "total_prod_price", "discount_percent", "site_id", F.lit(SHOP),
    )
    pos = pos_orders(inp, line_key).select(
        F.to_date("ordered_date"),
        item_uuid(POS, "item_id", sep=sep),
        as_text("id"),
        "quantity", "price", "discount", "shop_id", F.lit(POS),
    )
    return union_conformed(ORDER_FACT, shop, pos)


def discounted_orders_ranked(inp: Inputs) -> DataFrame:
    """Order versions with a discount, ranked newest first per order (the
    discount filter runs before the ranking, as in the source)."""
    h = inp.pos_order_history.where(F.col("total_discount") > 0)
    ranked = rank_versions(h, ["id"], "updated_time", CHANGE_ORDER, "orderrownumber")
    return ranked.select(
        "id", "updated_time", "shop_id", "ordered_date", "received_date", "arrival_date", "ship_cost",
        percent("discount").alias("discount_pct"), "total_discount", "total_quantity", "orderrownumber",
    )
