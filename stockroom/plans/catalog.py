"""Web-shop product and option information views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.sources.fixtures import Inputs

# Output columns of the two views, in order, per relation.
PRODUCT_INFO_COLUMNS = [
    ("brand", "brand_code"), ("product", "prod_sku"), ("picture", "image"), ("picture", "thumbnail"), ("here", "prod_name"),
    ("here", "prod_active"), ("product", "prod_id"), ("product", "prod_brand"), ("here", "prod_description"),
    ("product", "wholesale_price"), ("here", "prod_price"), ("here", "original_price"), ("here", "show_adjust"),
    ("here", "discount_percent"), ("here", "discount_group_id"), ("link", "url"), ("product", "made_in_usa"),
    ("here", "prod_new"), ("here", "prod_coming_soon"), ("picture", "hi_rez"), ("product", "product_set"),
    ("shade", "name"), ("product", "in_stock"), ("here", "meta_title"), ("here", "notify_off"), ("product", "exclusive"),
    ("product", "limited_edition"), ("here", "plus_size"), ("product", "sexy_rating"), ("here", "meta_keywords"),
    ("product", "size_chart_id"), ("picture", "option_color"), ("product", "pla_filter"), ("product", "discontinued"),
    ("here", "date_added"), ("here", "intro_text"), ("brand", "brand_name"), ("product", "ptype"), ("product", "n2"),
    ("picture", "has_logo"), ("here", "prod_fabric"), ("product", "google_feed"), ("here", "meta_description"),
    ("here", "secret_keywords"), ("product", "usp"), ("product", "sales_rank"), ("here", "prod_pending"),
]

# (alias, column, output name)
OPTION_INFO_COLUMNS = [
    ("brand", "brand_name", None), ("brand", "brand_code", None), ("product", "prod_id", None), ("product", "prod_sku", None),
    ("choice", "option_sku", None), ("shade", "name", "color"), ("measure", "name", "size"),
    ("cut", "name", "style"), ("choice", "option_inv", None), ("choice", "prod_option_id", None),
    ("here", "prod_price", None), ("choice", "la_upc", None), ("here", "prod_active", None),
    ("here", "prod_description", None), ("product", "wholesale_price", None),
    ("shade", "variant_id", "option_color"), ("measure", "variant_order", None), ("choice", "discontinued", None),
    ("choice", "la_sku", None), ("choice", "option_active", None), ("choice", "asin_size", None),
    ("choice", "asin_color", None), ("brand", "brand_id", None), ("choice", "asin_brand", "brand2"),
    ("measure", "variant_id", "option_size"), ("cut", "variant_id", "option_style"),
    ("here", "prod_name", None), ("choice", "asin", None), ("choice", "option_wholesale", None),
    ("choice", "option_price", None), ("here", "discount_percent", None), ("here", "discount_group_id", None),
    ("choice", "wmarked", None), ("choice", "dropshippable", None), ("choice", "pleaser_inv", None),
    ("choice", "sizes_table_id", None), ("measure", "general_size", None), ("choice", "last_certify", None),
    ("choice", "wmarked_tmp", None), ("product", "discontinued", "prod_discontinued"), ("here", "date_added", None),
    ("choice", "offsite_inv", None), ("choice", "bin_capacity", None), ("choice", "is_club", None), ("choice", "accy", None),
    ("choice", "exclusive", None), ("choice", "ell_color_code", None), ("brand", "discount_percent", "brand_discount"),
    ("choice", "bin_current", None), ("choice", "sale_speed", None), ("choice", "bo_schedule", None),
    ("choice", "on_way", None), ("here", "original_price", None), ("product", "ptype", None), ("choice", "extra_upc", None),
    ("choice", "on_order", None), ("product", "n2", None), ("choice", "wholesale_price2", None),
    ("choice", "catalog_price", None), ("choice", "catalog_discount", None), ("choice", "vendor_discontinued", None),
    ("choice", "closeout", None), ("choice", "spd_rank", None), ("choice", "fba_inventory", None),
    ("choice", "oos_until", None), ("choice", "inventory_status", None), ("variant_link", "scs_id", None),
    ("choice", "inception", None),
]


def _at_site(table: DataFrame, site_id: int, name: str, *conditions) -> DataFrame:
    """One site's rows of a per-site table, filtered before any join."""
    out = table.where(F.col("site_id") == site_id)
    for c in conditions:
        out = out.where(c)
    return out.alias(name)


def _branded_products(inp: Inputs) -> DataFrame:
    product, brand = inp.shop_products.alias("product"), inp.shop_brands.alias("brand")
    return product.join(brand, F.col("product.prod_brand") == F.col("brand.brand_id"))


def product_info(inp: Inputs, site_id: int = 1) -> DataFrame:
    """Product, brand, main image, url, colour name and site attributes."""
    here = _at_site(inp.shop_products_site, site_id, "here")
    picture = _at_site(inp.shop_images, site_id, "picture", F.col("main_image"))
    link = _at_site(inp.shop_urls, site_id, "link", F.col("type") == 1)
    shade = inp.shop_option_variants.alias("shade")
    number = F.col("product.prod_id")
    found = (
        _branded_products(inp)
        .join(here, F.col("here.prod_id") == number)
        .join(picture, F.col("picture.prod_id") == number, "left")
        .join(shade, F.col("shade.variant_id") == F.col("picture.option_color"), "left")
        .join(link, F.col("link.associated_id") == number, "left")
    )
    return found.select(*[F.col(f"{a}.{c}").alias(c) for a, c in PRODUCT_INFO_COLUMNS])


def option_info(inp: Inputs, site_id: int = 1) -> DataFrame:
    """Option, product, brand and the three variant roles (size, style, colour),
    ordered by colour name then size order."""
    choice = inp.shop_product_options.alias("choice")
    here = _at_site(inp.shop_products_site, site_id, "here")
    variant_link = _at_site(inp.shop_platform_link, site_id, "variant_link", F.col("type") == "variant")
    found = (
        choice.join(_branded_products(inp), F.col("choice.prod_id") == F.col("product.prod_id"))
        .join(here, F.col("here.prod_id") == F.col("product.prod_id"), "left")
        .join(variant_link, F.col("variant_link.id") == F.col("choice.prod_option_id"), "left")
    )
    for role, column in (("measure", "option_size"), ("cut", "option_style"), ("shade", "option_color")):
        variant = inp.shop_option_variants.alias(role)
        found = found.join(variant, F.col(f"{role}.variant_id") == F.col(f"choice.{column}"), "left")
    out = found.select(*[F.col(f"{a}.{c}").alias(o or c) for a, c, o in OPTION_INFO_COLUMNS])
    return out.orderBy(F.col("color").asc_nulls_last(), F.col("variant_order").asc_nulls_last())
