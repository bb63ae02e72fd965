"""Declared target schemas and source labels.

Quantities declared SMALLINT in the source DDL are integers without a 32767
limit there, so they are ``bigint`` here; ``NUMBER`` without scale is
``decimal(38,0)``.
"""

import re

from pyspark.sql.types import (
    LongType,
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _schema(ddl: str) -> StructType:
    """``"name TYPE, ..."`` to a ``StructType`` (needs no running session)."""
    simple = {"DATE": DateType(), "INT": IntegerType(), "BIGINT": LongType(), "STRING": StringType()}
    fields = []
    for part in re.split(r",\s*(?![^()]*\))", ddl.strip()):
        name, typ = part.split(None, 1)
        m = re.fullmatch(r"DECIMAL\((\d+),(\d+)\)", typ)
        fields.append(StructField(name, DecimalType(int(m[1]), int(m[2])) if m else simple[typ], True))
    return StructType(fields)

# Fixed labels of the three source systems, stored in every conformed row.
POS = "pos"
SHOP = "shop"
ECOM = "ecom"
# Shop name given to e-commerce stock rows.
ECOM_SHOP_NAME = "ecom store"

# Columns and types of the target tables.
DATE_DIM = _schema(
    "date DATE, year INT, month INT, month_name STRING, day_of_mon INT, "
    "day_of_week STRING, week_of_year INT, day_of_year INT"
)
ITEM_DIM = _schema(
    "sku STRING, uuid STRING, brandname STRING, vendorid STRING, categoryid STRING, "
    "description STRING, color STRING, size STRING, attribute3 STRING, source STRING"
)
LOCATION_DIM = _schema("locationid STRING, locationname STRING, category STRING, source STRING")
ORDER_FACT = _schema(
    "date DATE, itemuuid STRING, orderuuid STRING, qty_sold BIGINT, price DECIMAL(10,2), "
    "discount DECIMAL(38,0), locationid STRING, source STRING"
)
INVENTORY_FACT = _schema(
    "date DATE, sku STRING, itemuuid STRING, qoh BIGINT, backorder BIGINT, cost DECIMAL(6,2), "
    "locationid STRING, categoryid STRING, source STRING"
)
STOCK_SNAPSHOT = _schema(
    "rowuuid STRING, insertdate DATE, valuelastupdateddate STRING, sku STRING, itemuuid STRING, "
    "qoh BIGINT, backorder BIGINT, cost DECIMAL(10,2), locationid STRING, categoryid STRING"
)

# Longest text of the declared columns (255 where not listed) and
# the NOT NULL columns of the declared targets
_LONGEST = {
    "date_dim": {"month_name": 3, "day_of_week": 9},
    "item_dim": {"sku": 100, "categoryid": 100, "color": 100, "source": 30},
    "location_dim": {"locationid": 100, "source": 30},
    "order_fact": {"locationid": 50, "source": 100},
    "inventory_fact": {"locationid": 50, "categoryid": 100, "source": 100},
    "stock_snapshot_history": {"locationid": 50, "categoryid": 150},
}


def longest(table: str, schema: StructType) -> dict[str, int]:
    """Greatest number of characters of each text column of a target table."""
    return {f.name: _LONGEST[table].get(f.name, 255) for f in schema.fields if isinstance(f.dataType, StringType)}


# NOT NULL columns
REQUIRED = {
    "date_dim": [f.name for f in DATE_DIM.fields],
    "inventory_fact": ["date"],
    "item_dim": ["uuid"],
    "location_dim": ["locationname"],
}
