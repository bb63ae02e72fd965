"""Load audit: average rows loaded per month, per source system."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.functions import avg_to_bigint, month_end
from stockroom.plans.schemas import ECOM, POS, SHOP
from stockroom.sources.fixtures import Inputs

AUDIT_LOGS = ((POS, "audit_pos"), (SHOP, "audit_shop"), (ECOM, "audit_ecom"))


def audit_monthly_avg(inp: Inputs) -> DataFrame:
    parts = [
        inp[table].groupBy(month_end(F.to_date("done")).alias("month_end"))
        .agg(avg_to_bigint("rows_updated_or_inserted").alias("avg_rows"))
        .select(F.lit(label).alias("source"), "month_end", "avg_rows")
        for label, table in AUDIT_LOGS
    ]
    return reduce(DataFrame.unionAll, parts)
