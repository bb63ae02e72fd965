"""Item dimension: point-of-sale items and web-shop product options."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.functions import ITEM_UUID_SEP, as_text, item_uuid, typed_null
from stockroom.operators.conform import union_conformed
from stockroom.operators.dedup import latest_per_key
from stockroom.plans.schemas import ITEM_DIM, POS, SHOP
from stockroom.sources.fixtures import CHANGE_ORDER, Inputs


def pos_items(inp: Inputs, sep: str = ITEM_UUID_SEP) -> DataFrame:
    """Newest version of each item with the newest vendor and brand names."""
    item = inp.latest("pos_item_history")
    vendor = latest_per_key(inp.pos_vendor_history, ["id"], "updated_time", CHANGE_ORDER, ["name"])
    brand = latest_per_key(inp.pos_manufacturer_history, ["id"], "updated_time", CHANGE_ORDER, ["name"])
    joined = (
        item.join(vendor.select(F.col("id").alias("_vid"), F.col("name").alias("vendorname")),
                  F.col("default_vendor_id") == F.col("_vid"))
        # the source joins the text form of the manufacturer id to the numeric id;
        # joining the numeric columns gives the same pairs
        .join(brand.select(F.col("id").alias("_bid"), F.col("name").alias("brandname")),
              F.col("manufacturer_id") == F.col("_bid"))
    )
    return joined.select(
        "id",
        item_uuid(POS, "id", sep=sep).alias("uuid"),
        "custom_sku",
        as_text("manufacturer_id").alias("manufacturerid"),
        F.col("default_vendor_id").alias("vendorid"),
        as_text("category_id").alias("categoryid"),
        "description", "attribute_1", "attribute_2", "attribute_3",
        "vendorname", "brandname",
        F.lit(1).alias("itemrownumber"), F.lit(1).alias("vendorrownumber"), F.lit(1).alias("brandrownumber"),
    )


def shop_brands(inp: Inputs) -> DataFrame:
    return inp.shop_brands.join(inp.shop_products, F.col("brand_id") == F.col("prod_brand")).select(
        "brand_code", "brand_name", "prod_id", "prod_sku"
    )


def vendor_sku(inp: Inputs) -> DataFrame:
    """Vendor SKU ``brand_code-prod_sku`` next to the internal product id."""
    return shop_brands(inp).select(
        "prod_id", "brand_code", "prod_sku",
        F.concat("brand_code", F.lit("-"), "prod_sku").alias("vendor_sku"),
    )


def shop_category_ids(inp: Inputs) -> DataFrame:
    return inp.shop_products.select(
        "prod_id", "ptype", "n2", "location", F.concat("ptype", F.lit("_"), "n2").alias("categoryid")
    )


def shop_options(inp: Inputs, site_id: int = 1, sep: str = ITEM_UUID_SEP) -> DataFrame:
    po = inp.shop_product_options
    b = shop_brands(inp).select(F.col("prod_id").alias("_bprod"), "brand_name", "brand_code", "prod_sku")
    pss = inp.shop_products_site.where(F.col("site_id") == site_id).select(
        F.col("prod_id").alias("_sprod"), F.col("prod_name").alias("productname")
    )
    j = po.join(b, po["prod_id"] == b["_bprod"]).join(pss, po["prod_id"] == pss["_sprod"], "left")
    return j.select(
        item_uuid(SHOP, "prod_id", "prod_option_id", sep=sep).alias("uuid"),
        "prod_id", "prod_option_id", "option_sku", "option_color", "brand_name", "brand_code",
        "option_size", "option_style", "sizes_table_id", "prod_sku", "productname",
    )


def shop_sizes(inp: Inputs) -> DataFrame:
    """Distinct size types (``GROUP BY`` with no aggregate)."""
    return inp.shop_sizes.select("size_type_id", "size_type").distinct()


def shop_items(inp: Inputs, site_id: int = 1, sep: str = ITEM_UUID_SEP) -> DataFrame:
    o = shop_options(inp, site_id, sep)
    cat = shop_category_ids(inp).select(F.col("prod_id").alias("_cprod"), "categoryid")
    colors = inp.shop_colors.select("prod_color_id", "color_name")
    j = (
        o.join(cat, o["prod_id"] == cat["_cprod"])
        .join(colors, o["option_color"] == colors["prod_color_id"])
        .join(shop_sizes(inp), o["sizes_table_id"] == F.col("size_type_id"))
    )
    return j.select(
        "uuid", "prod_id", "prod_option_id",
        F.concat("prod_sku", F.lit("/"), "option_sku").alias("sku"),
        "productname", "brand_name", "option_size", "option_style", "sizes_table_id",
        "categoryid", "color_name", "size_type",
    )


def item_dim(inp: Inputs, sep: str = ITEM_UUID_SEP) -> DataFrame:
    shop = shop_items(inp, sep=sep).select(
        "sku", "uuid", "brand_name", typed_null("string"), "categoryid", "productname",
        "color_name", "size_type", typed_null("string"), F.lit(SHOP),
    )
    pos = pos_items(inp, sep=sep).select(
        "custom_sku", "uuid", "brandname", "vendorname", "categoryid", "description",
        "attribute_1", "attribute_2", "attribute_3", F.lit(POS),
    )
    return union_conformed(ITEM_DIM, shop, pos)
