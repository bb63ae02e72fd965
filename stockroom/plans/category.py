"""Category path parsing and product-type lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.functions import non_blank, path_level
from stockroom.operators.dedup import rank_versions
from stockroom.sources.fixtures import Inputs


def _levels(name: str = "name") -> list:
    # level 1 strips the whole path before splitting; levels 2-5 strip the part
    return [path_level(name, 1, trim_whole_first=True).alias("category1")] + [
        path_level(name, n).alias(f"category{n}") for n in range(2, 6)
    ]


def category_levels_ranked(inp: Inputs) -> DataFrame:
    """Every distinct category version with its five path levels and its
    version number (1 = newest) per category."""
    versions = inp.pos_category_history.select(
        "id", "updated_time", "name", "full_path_name", "node_depth"
    )
    ranked = rank_versions(
        versions, ["id"], "updated_time", ["name", "full_path_name", "node_depth"], "rownumber", distinct=True
    )
    return ranked.select("id", "full_path_name", "node_depth", *_levels(), "rownumber")


def item_category_distinct(inp: Inputs) -> DataFrame:
    """Distinct categories (all versions) used by any item version, with levels.

    The source joins every item version to every category version and takes
    distinct rows of category columns only; a semi-join on the distinct
    category ids gives the same rows without the fan-out.
    """
    used = inp.pos_item_history.select(F.col("category_id").alias("_cid")).distinct()
    cats = inp.pos_category_history.join(used, F.col("id") == F.col("_cid"), "left_semi")
    return cats.select(
        F.col("id").alias("category_id"), "full_path_name", "node_depth", *_levels()
    ).distinct()


def product_type_pairs(inp: Inputs) -> DataFrame:
    return inp.shop_products.select("ptype", "n2").distinct()


def active_product_types(inp: Inputs) -> DataFrame:
    """Product types of active products that have a variant with a non-blank SKU."""
    p = inp.ecom_product.where(F.col("status") == "active")
    v = inp.ecom_variant.where(non_blank("sku"))
    return p.join(v, p["id"] == v["product_id"]).select("product_type").distinct()


def table_passthrough(inp: Inputs, table: str = "category_mapping") -> DataFrame:
    """``SELECT *`` of a table: the category mapping, or the e-commerce product tags."""
    return inp[table]
