"""Location dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.functions import typed_null
from stockroom.operators.conform import union_conformed
from stockroom.operators.dedup import latest_per_key
from stockroom.plans.schemas import LOCATION_DIM, POS, SHOP
from stockroom.sources.fixtures import CHANGE_ORDER, Inputs


def location_latest(inp: Inputs) -> DataFrame:
    latest = latest_per_key(
        inp.pos_shop_history, ["id"], "updated_time", CHANGE_ORDER, ["updated_time", "name", "time_zone"]
    )
    return latest.withColumn("locationrownumber", F.lit(1))


def location_dim(inp: Inputs) -> DataFrame:
    """One all-null row per web-shop location (the shop has no location data),
    then the newest version of each point-of-sale shop.  The time zone lands in
    the third column, ``category``, by position."""
    shop = inp.shop_locations.select(
        typed_null("string"), typed_null("string"), typed_null("string"), F.lit(SHOP)
    )
    pos = location_latest(inp).select("id", "name", "time_zone", F.lit(POS))
    return union_conformed(LOCATION_DIM, shop, pos)
