"""Cross-channel stock detail: point-of-sale stock history and e-commerce levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.functions import path_level, typed_null
from stockroom.operators.dedup import latest_per_key, rank_versions
from stockroom.plans.schemas import ECOM, ECOM_SHOP_NAME, POS
from stockroom.sources.fixtures import Inputs

CHANNEL_COLUMNS = [
    "source", "id", "category1", "category2", "category3", "date", "year", "month", "week",
    "itemdescription", "attribute_1", "attribute_2", "attribute_3", "default_cost", "sku", "status",
    "qoh", "backorder", "reorder_point", "reorder_level", "shopname", "time_zone", "rn",
]

_ITEM_COLS = ["category_id", "description", "attribute_1", "attribute_2", "attribute_3", "default_cost",
              "avg_cost", "custom_sku", "manufacturer_sku", "publish_to_ecom"]
_STOCK_COLS = ["qoh", "backorder", "component_qoh", "component_backorder", "reorder_point", "reorder_level"]


def _pos_branch(inp: Inputs) -> DataFrame:
    # The source groups each history by every selected column.  For a newest
    # row, whose order covers all those columns, that changes nothing; the stock
    # history, whose ranks are kept, needs it: it is made distinct, ranked and
    # written in one pass, and pairs and join read that table.
    item = latest_per_key(inp.pos_item_history, ["id"], "updated_time", _ITEM_COLS, _ITEM_COLS)
    ranked = rank_versions(
        inp.pos_item_shop_history.select("id", "item_id", "shop_id", "updated_time", *_STOCK_COLS),
        ["id", "item_id", "shop_id"], "updated_time", _STOCK_COLS, "rn", distinct=True,
    )
    shop = latest_per_key(inp.pos_shop_history, ["id"], "updated_time", ["name", "time_zone"], ["name", "time_zone"])
    cat = latest_per_key(inp.pos_category_history, ["id"], "updated_time", ["name", "full_path_name"], ["name"])

    it = item.select(F.col("id").alias("item_key"), *[F.col(c) for c in _ITEM_COLS])
    ct = cat.select(F.col("id").alias("_cat_id"), F.col("name").alias("_cat_name"))
    sh = shop.select(F.col("id").alias("_shop_id"), F.col("name").alias("shopname"), "time_zone")
    # the few shops and categories meet the newest item of each (item, shop)
    # pair; the wide history then needs one join, on the fine pair key
    pairs = ranked.select(F.col("item_id").alias("_item"), F.col("shop_id").alias("_shop")).distinct()
    about = (
        pairs.join(it.join(ct, it["category_id"] == ct["_cat_id"]), F.col("_item") == F.col("item_key"))
        .join(sh, F.col("_shop") == sh["_shop_id"])
    )
    j = ranked.join(about, (ranked["item_id"] == about["_item"]) & (ranked["shop_id"] == about["_shop"]))
    t = F.col("updated_time")
    return j.select(
        F.lit(POS).alias("source"),
        F.col("item_key").alias("id"),
        *[path_level("_cat_name", n).alias(f"category{n}") for n in (1, 2, 3)],
        F.to_date(t).alias("date"), F.year(t).alias("year"), F.month(t).alias("month"),
        F.weekofyear(t).alias("week"),
        F.col("description").alias("itemdescription"),
        "attribute_1", "attribute_2", "attribute_3", "default_cost",
        F.col("custom_sku").alias("sku"),
        typed_null("string").alias("status"),
        "qoh", "backorder", "reorder_point", "reorder_level", "shopname", "time_zone", "rn",
    )


def _ecom_branch(inp: Inputs) -> DataFrame:
    p, v = inp.ecom_product, inp.ecom_variant
    ii, il = inp.ecom_inventory_item, inp.ecom_inventory_level
    j = (
        p.join(v, p["id"] == v["product_id"])
        .join(ii, v["inventory_item_id"] == ii["id"])
        .join(il, v["inventory_item_id"] == il["inventory_item_id"])
    )
    t = il["updated_at"]
    return j.select(
        F.lit(ECOM).alias("source"),
        p["id"].alias("id"),
        F.col("product_type").alias("category1"),
        typed_null("string").alias("category2"),
        typed_null("string").alias("category3"),
        F.to_date(t).alias("date"), F.year(t).alias("year"), F.month(t).alias("month"),
        F.weekofyear(t).alias("week"),
        F.col("title").alias("itemdescription"),
        F.col("option_1").alias("attribute_1"),
        F.col("option_2").alias("attribute_2"),
        F.col("option_3").alias("attribute_3"),
        F.col("cost").alias("default_cost"),
        F.col("sku"),
        F.col("status"),
        F.col("available").alias("qoh"),
        typed_null("bigint").alias("backorder"),
        typed_null("bigint").alias("reorder_point"),
        typed_null("bigint").alias("reorder_level"),
        F.lit(ECOM_SHOP_NAME).alias("shopname"),
        typed_null("string").alias("time_zone"),
        F.lit(1).alias("rn"),
    )


def channel_inventory(inp: Inputs) -> DataFrame:
    """Every version of point-of-sale stock per item and shop (with its version
    number) joined to the newest item, category and shop, plus e-commerce stock
    levels, in one 23-column layout."""
    return _pos_branch(inp).unionByName(_ecom_branch(inp)).select(*CHANNEL_COLUMNS)
