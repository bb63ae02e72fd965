"""Source-shaped inputs projected from the driver's TPC-H-like tables.

The retail jobs read change-log ("history") tables of a point-of-sale system
(``pos_*``), tables of a web shop (``shop_*``) and of an e-commerce platform
(``ecom_*``).  The test data has none of these, so each one is declared here as
a projection of the driver tables.  One declaration serves both engines: Spark
builds it with ``selectExpr`` over a DataFrame join, and the DuckDB oracle
(``stockroom.oracle``) wraps the same expressions in a CTE.  An expression is a
string valid in both dialects, or a ``(spark, duckdb)`` pair where they differ.

Money is derived through whole cents (``round(x * 100)`` of a two-decimal
double, then ``* 0.01``) so that no engine has to round a binary fraction.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Expr = str | tuple[str, str]

# tie-breakers of rows of one key landed at the same time
CHANGE_ORDER = ["change_seq", "change_line", "change_part", "change_sub"]

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _cents(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


def _money(x: str, scale_type: str = "DECIMAL(10,2)") -> str:
    return f"CAST({_cents(x)} * 0.01 AS {scale_type})"


def _div(a: str, b: str) -> tuple[str, str]:
    return (f"(({a}) div ({b}))", f"(({a}) // ({b}))")


def _unit_price(divisor: int = 1) -> tuple[str, str]:
    """l_extendedprice / l_quantity / divisor, rounded half up to cents."""
    cents, qty = _cents("l_extendedprice"), "CAST(l_quantity AS BIGINT)"
    sp, dk = _div(f"2 * {cents} + {divisor} * {qty}", f"2 * {divisor} * {qty}")
    return (f"CAST({sp} * 0.01 AS DECIMAL(10,2))", f"CAST({dk} * 0.01 AS DECIMAL(10,2))")


def _days_after_2000(n: str) -> tuple[str, str]:
    return (
        f"CAST(date_add(DATE'2000-01-01', CAST({n} AS INT)) AS TIMESTAMP_NTZ)",
        f"CAST(DATE '2000-01-01' + CAST({n} AS INTEGER) AS TIMESTAMP)",
    )


# Stock and shop changes: the events of January 2024 moved to December 2001, so
# that they lie on the date spine, before and between the snapshot's run days.
EVENT_TIME: tuple[str, str] = ("ts - INTERVAL '8065' DAY", "ts - INTERVAL '8065 days'")
NULL_TS: tuple[str, str] = ("CAST(NULL AS TIMESTAMP_NTZ)", "CAST(NULL AS TIMESTAMP)")
BRAND_NO = "CAST(substring(p_brand, 7) AS BIGINT)"
# Change-log order of rows landed at the same time, in columns of its own: for
# lineitem the four keys that tell its rows apart, else one sequence number.
LINE_CHANGE: list[tuple[str, "Expr"]] = [
    ("change_seq", "l_orderkey"), ("change_line", "CAST(l_linenumber AS BIGINT)"), ("change_part", "l_partkey"),
    ("change_sub", "l_suppkey"),
]


def _change(seq: str) -> list[tuple[str, "Expr"]]:
    zero = "CAST(0 AS BIGINT)"
    return [("change_seq", seq), ("change_line", zero), ("change_part", zero), ("change_sub", zero)]


RETAIL = _money("p_retailprice")


@dataclass(frozen=True)
class Source:
    name: str
    # driver tables joined into the base row set
    spark_base: Callable[[Callable[[str], DataFrame]], DataFrame]
    duck_from: str
    columns: list[tuple[str, Expr]] = field(default_factory=list)

    def spark_exprs(self) -> list[str]:
        return [f"{e[0] if isinstance(e, tuple) else e} AS {n}" for n, e in self.columns]

    def duck_exprs(self) -> list[str]:
        return [f"{e[1] if isinstance(e, tuple) else e} AS {n}" for n, e in self.columns]

    def duck_sql(self) -> str:
        return f"SELECT {', '.join(self.duck_exprs())} FROM {self.duck_from}"


# ---- derived code frames (computed over distinct values, never the whole table) ----

def _shop_codes(t: Callable[[str], DataFrame]) -> DataFrame:
    """Shop number = position of the event type in alphabetical order."""
    kinds = t("events").select("event_type").distinct()
    return kinds.select(
        F.col("event_type").alias("_et"),
        F.dense_rank().over(Window.orderBy("event_type")).cast("bigint").alias("shop_no"),
    )


_DUCK_SHOP_CODES = (
    "(SELECT event_type AS _et, CAST(dense_rank() OVER (ORDER BY event_type) AS BIGINT) AS shop_no "
    "FROM (SELECT DISTINCT event_type FROM events)) _sc"
)


def _color_codes(t: Callable[[str], DataFrame]) -> DataFrame:
    """Colour code = position of the first word of the part name, alphabetically."""
    words = t("part").groupBy(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("_w")).agg(
        F.min("p_partkey").alias("_first_part")
    )
    return words.withColumn("color_no", F.dense_rank().over(Window.orderBy("_w")).cast("bigint"))


_DUCK_COLOR_CODES = (
    "(SELECT _w, _first_part, CAST(dense_rank() OVER (ORDER BY _w) AS BIGINT) AS color_no FROM "
    "(SELECT split_part(p_name, ' ', 1) AS _w, min(p_partkey) AS _first_part FROM part GROUP BY 1)) _cc"
)


def _events_with_shop(t):
    return t("events").join(_shop_codes(t), F.col("event_type") == F.col("_et"))


def _part_with_color(t):
    cc = _color_codes(t)
    return t("part").join(cc, F.split_part("p_name", F.lit(" "), F.lit(1)) == F.col("_w"))


_EVENTS_SHOP_FROM = f"events JOIN {_DUCK_SHOP_CODES} ON events.event_type = _sc._et"
_PART_COLOR_FROM = f"part JOIN {_DUCK_COLOR_CODES} ON split_part(p_name, ' ', 1) = _cc._w"


def _t(name):
    return lambda t: t(name)


SOURCES: dict[str, Source] = {}


def _add(src: Source) -> None:
    SOURCES[src.name] = src


# ---------------- point-of-sale change logs ----------------
_add(Source(
    "pos_item_history",
    lambda t: t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")),
    "lineitem JOIN part ON l_partkey = p_partkey",
    [
        ("id", "l_partkey"),
        ("category_id", "CAST(p_size AS BIGINT)"),
        ("updated_time", "l_shipdate"),
        ("custom_sku", "'SKU-' || CAST(l_partkey AS STRING)"),
        ("manufacturer_sku", "'M' || CAST(l_partkey AS STRING)"),
        ("manufacturer_id", BRAND_NO),
        ("default_vendor_id", "l_suppkey"),
        ("description", "p_name"),
        ("attribute_1", "p_type"),
        ("attribute_2", "CAST(p_size AS STRING)"),
        ("attribute_3", "l_returnflag"),
        ("default_cost", RETAIL),
        ("avg_cost", _unit_price(100)),
        ("publish_to_ecom", "l_linestatus = 'O'"),
        *LINE_CHANGE,
    ],
))
_add(Source(
    "pos_item_shop_history",
    _events_with_shop,
    _EVENTS_SHOP_FROM,
    [
        ("id", "user_id"),
        ("item_id", "user_id"),
        ("shop_id", "shop_no"),
        ("updated_time", EVENT_TIME),
        ("qoh", "CAST(floor(value) AS BIGINT)"),
        ("backorder", "CAST(floor(value) AS BIGINT) % 7"),
        ("component_qoh", "CAST(floor(value) AS BIGINT) % 3"),
        ("component_backorder", "CAST(0 AS BIGINT)"),
        ("reorder_point", "CAST(5 AS BIGINT)"),
        ("reorder_level", "CAST(10 AS BIGINT)"),
        *_change("event_id"),
    ],
))
_add(Source(
    "pos_shop_history",
    _events_with_shop,
    _EVENTS_SHOP_FROM,
    [
        ("id", "shop_no"),
        ("updated_time", EVENT_TIME),
        ("name", "'Shop ' || event_type || ' ' || CAST(event_id AS STRING)"),
        ("time_zone", "CASE WHEN shop_no % 3 = 0 THEN 'UTC' WHEN shop_no % 3 = 1 THEN 'Europe/Berlin' ELSE 'America/Denver' END"),
        *_change("event_id"),
    ],
))
_add(Source(
    "pos_category_history",
    _t("part"),
    "part",
    [
        ("id", "CAST(p_size AS BIGINT)"),
        ("updated_time", _days_after_2000("p_partkey")),
        ("name", "' $.' || p_type || './ ' || p_name || ' /' || p_brand || ' $'"),
        ("full_path_name", "p_type || '/' || p_name"),
        ("node_depth", "CAST(p_partkey % 5 AS INT)"),
        *_change("p_partkey"),
    ],
))
_add(Source(
    "pos_vendor_history",
    _t("lineitem"),
    "lineitem",
    [
        ("id", "l_suppkey"),
        ("updated_time", "l_shipdate"),
        ("name", "'Vendor ' || CAST(l_suppkey AS STRING) || l_linestatus"),
        *LINE_CHANGE,
    ],
))
_add(Source(
    "pos_manufacturer_history",
    _t("part"),
    "part",
    [
        ("id", BRAND_NO),
        ("updated_time", _days_after_2000("p_partkey")),
        ("name", "p_brand || ' ' || p_type"),
        *_change("p_partkey"),
    ],
))
_add(Source(
    "pos_order_history",
    lambda t: t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")),
    "lineitem JOIN orders ON l_orderkey = o_orderkey",
    [
        ("id", "l_orderkey"),
        ("shop_id", "l_suppkey % 5 + 1"),
        ("updated_time", "l_shipdate"),
        ("ordered_date", "o_orderdate"),
        ("received_date", "l_shipdate"),
        ("arrival_date", NULL_TS),
        ("ship_cost", _money("l_tax")),
        ("discount", _money("l_discount")),
        ("total_discount", _money("l_discount")),
        ("total_quantity", "CAST(l_quantity AS BIGINT)"),
        *LINE_CHANGE,
    ],
))
_add(Source(
    "pos_order_line_history",
    _t("lineitem"),
    "lineitem",
    [
        ("id", "l_orderkey * 10 + l_linenumber"),
        ("order_id", "l_orderkey"),
        ("item_id", "l_partkey"),
        ("updated_time", "l_shipdate"),
        ("total", _money("l_extendedprice", "DECIMAL(12,2)")),
        ("price", _unit_price(1)),
        ("original_price", _unit_price(1)),
        ("quantity", "CAST(l_quantity AS BIGINT)"),
        *LINE_CHANGE,
    ],
))

# ---------------- web shop tables ----------------
_add(Source(
    "shop_products",
    _t("part"),
    "part",
    [
        ("prod_id", "p_partkey"),
        ("prod_brand", BRAND_NO),
        ("prod_sku", "'P' || CAST(p_partkey AS STRING)"),
        ("ptype", "p_type"),
        ("n2", "CAST(p_size AS STRING)"),
        ("location", "'L' || CAST(p_size % 4 AS STRING)"),
        ("wholesale_price", f"CAST({RETAIL} - 100 AS DECIMAL(10,2))"),
        ("made_in_usa", "p_size % 2 = 0"),
        ("product_set", "CAST(p_partkey % 7 AS BIGINT)"),
        ("in_stock", "p_size > 10"),
        ("exclusive", "p_partkey % 11 = 0"),
        ("limited_edition", "p_partkey % 13 = 0"),
        ("sexy_rating", "CAST(p_size % 5 AS INT)"),
        ("size_chart_id", "CAST(p_size % 6 AS BIGINT)"),
        ("pla_filter", "p_partkey % 3 = 0"),
        ("discontinued", "p_partkey % 17 = 0"),
        ("google_feed", "p_size % 3 <> 0"),
        ("usp", "'USP ' || p_type"),
        ("sales_rank", "p_partkey"),
    ],
))
_add(Source(
    "shop_products_site",
    _t("part"),
    "part",
    [
        ("prod_id", "p_partkey"),
        ("site_id", "CAST(CASE WHEN p_partkey % 3 <> 0 THEN 1 ELSE 2 END AS BIGINT)"),
        ("prod_name", "p_name"),
        ("prod_active", "p_size % 2 = 0"),
        ("prod_description", "p_name || ' in ' || p_type"),
        ("prod_price", RETAIL),
        ("original_price", f"CAST({RETAIL} + 10 AS DECIMAL(10,2))"),
        ("show_adjust", "p_size % 4 = 0"),
        ("discount_percent", "CAST(p_size % 10 AS DECIMAL(5,2))"),
        ("discount_group_id", "CAST(p_size % 3 AS BIGINT)"),
        ("prod_new", "p_partkey % 5 = 0"),
        ("prod_coming_soon", "p_partkey % 19 = 0"),
        ("meta_title", "p_name || ' | ' || p_brand"),
        ("notify_off", "p_size % 7 = 0"),
        ("plus_size", "p_size > 40"),
        ("meta_keywords", "p_type || ',' || p_name"),
        ("date_added", _days_after_2000("p_partkey")),
        ("intro_text", "'Intro ' || p_name"),
        ("prod_fabric", "'F' || CAST(p_size % 4 AS STRING)"),
        ("meta_description", "p_name || ' by ' || p_brand"),
        ("secret_keywords", "p_brand"),
        ("prod_pending", "p_partkey % 23 = 0"),
    ],
))
_add(Source(
    "shop_product_options",
    _part_with_color,
    _PART_COLOR_FROM,
    [
        ("prod_option_id", "p_partkey"),
        ("prod_id", "p_partkey"),
        ("option_sku", "'O' || CAST(p_partkey AS STRING)"),
        ("option_color", "color_no"),
        ("option_size", "CAST(p_size AS BIGINT)"),
        ("option_style", f"{BRAND_NO} + 100"),
        ("sizes_table_id", "CAST(p_size AS BIGINT)"),
        ("option_inv", "CAST(p_size * 3 AS BIGINT)"),
        ("la_upc", "'UPC' || CAST(p_partkey AS STRING)"),
        ("discontinued", "p_partkey % 17 = 0"),
        ("la_sku", "'LA' || CAST(p_partkey AS STRING)"),
        ("option_active", "p_size % 2 = 1"),
        ("asin_size", "'AS' || CAST(p_size AS STRING)"),
        ("asin_color", "'AC' || _w"),
        ("asin_brand", "p_brand"),
        ("asin", "'ASIN' || CAST(p_partkey AS STRING)"),
        ("option_wholesale", f"CAST({RETAIL} - 100 AS DECIMAL(10,2))"),
        ("option_price", RETAIL),
        ("wmarked", "p_partkey % 2 = 1"),
        ("dropshippable", "p_size % 5 = 0"),
        ("pleaser_inv", "CAST(p_size % 9 AS BIGINT)"),
        ("last_certify", _days_after_2000("p_size")),
        ("wmarked_tmp", "p_partkey % 29 = 0"),
        ("offsite_inv", "CAST(p_size % 4 AS BIGINT)"),
        ("bin_capacity", "CAST(p_size * 2 AS BIGINT)"),
        ("is_club", "p_partkey % 31 = 0"),
        ("accy", "p_type = 'SMALL'"),
        ("exclusive", "p_partkey % 11 = 0"),
        ("ell_color_code", "'E' || CAST(color_no AS STRING)"),
        ("bin_current", "CAST(p_size % 8 AS BIGINT)"),
        ("sale_speed", "CAST(p_size AS DECIMAL(10,2))"),
        ("bo_schedule", "'W' || CAST(p_size % 4 AS STRING)"),
        ("on_way", "CAST(p_size % 6 AS BIGINT)"),
        ("extra_upc", "'X' || CAST(p_partkey AS STRING)"),
        ("on_order", "CAST(p_size % 10 AS BIGINT)"),
        ("wholesale_price2", f"CAST({RETAIL} - 150 AS DECIMAL(10,2))"),
        ("catalog_price", RETAIL),
        ("catalog_discount", "CAST(p_size % 10 AS DECIMAL(5,2))"),
        ("vendor_discontinued", "p_partkey % 37 = 0"),
        ("closeout", "p_partkey % 41 = 0"),
        ("spd_rank", "p_partkey"),
        ("fba_inventory", "CAST(p_size % 12 AS BIGINT)"),
        ("oos_until", _days_after_2000("p_size * 10")),
        ("inventory_status", "'S' || CAST(p_size % 3 AS STRING)"),
        ("inception", _days_after_2000("p_partkey % 365")),
    ],
))
_add(Source(
    "shop_brands",
    lambda t: t("part").select("p_brand").distinct(),
    "(SELECT DISTINCT p_brand FROM part) _b",
    [
        ("brand_id", BRAND_NO),
        ("brand_code", f"'B' || CAST({BRAND_NO} AS STRING)"),
        ("brand_name", "p_brand"),
        ("discount_percent", f"CAST({BRAND_NO} % 10 AS DECIMAL(5,2))"),
    ],
))
_add(Source(
    "shop_sizes",
    _t("part"),
    "part",
    [("size_type_id", "CAST(p_size AS BIGINT)"), ("size_type", "'S' || CAST(p_size AS STRING)")],
))
_add(Source(
    "shop_colors",
    _color_codes,
    _DUCK_COLOR_CODES,
    [("prod_color_id", "color_no"), ("prod_id", "_first_part"), ("color_name", "_w")],
))
_add(Source(
    "shop_inventory_move",
    _t("lineitem"),
    "lineitem",
    [
        ("option_id", "l_partkey"),
        ("oldinv", "CAST(0 AS BIGINT)"),
        ("newinv", "CAST(l_quantity AS BIGINT)"),
        ("changetime", ("l_shipdate + make_interval(0, 0, 0, 0, l_linenumber, 0, 0)",
                        "l_shipdate + to_hours(l_linenumber)")),
        *LINE_CHANGE,
    ],
))
_add(Source(
    "shop_cost_ledger",
    _t("lineitem"),
    "lineitem",
    [
        ("prod_option_id", "l_partkey"),
        ("stamped", ("unix_timestamp(l_shipdate)", "CAST(epoch(l_shipdate) AS BIGINT)")),
        ("cost_price", _unit_price(100)),
    ],
))
_add(Source(
    "shop_orders",
    _t("orders"),
    "orders",
    [
        ("order_id", "o_orderkey"),
        ("order_date", "o_orderdate"),
        ("order_status", "CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 WHEN 'F' THEN 4 END AS INT)"),
    ],
))
_add(Source(
    "shop_order_lines",
    _t("lineitem"),
    "lineitem",
    [
        ("orders_prods_id", "l_orderkey"),
        ("prod_id", "l_partkey"),
        ("option_id", "l_partkey"),
        ("site_id", "CAST(l_linenumber % 2 + 1 AS BIGINT)"),
        ("quantity", "CAST(l_quantity AS BIGINT)"),
        ("backorder_date", ("CASE WHEN l_returnflag = 'R' THEN l_shipdate END",
                            "CASE WHEN l_returnflag = 'R' THEN l_shipdate END")),
        ("discount_percent", f"CAST({_cents('l_discount')} AS DECIMAL(5,2))"),
        ("tax", _money("l_tax")),
        ("total_prod_price", _money("l_extendedprice", "DECIMAL(12,2)")),
        ("returned", "l_returnflag = 'R'"),
    ],
))
_add(Source(
    "shop_locations",
    _t("nation"),
    "nation",
    [("location_id", "CAST(n_nationkey AS BIGINT)"), ("location_name", "n_name")],
))
_add(Source(
    "shop_images",
    _t("part"),
    "part",
    [
        ("prod_id", "p_partkey"),
        ("site_id", "CAST(1 AS BIGINT)"),
        ("option_color", "CAST(p_size AS BIGINT)"),
        ("main_image", "p_partkey % 2 = 0"),
        ("has_logo", "p_size % 3 = 0"),
        ("hi_rez", "p_size % 2 = 1"),
        ("image", "'img/' || CAST(p_partkey AS STRING) || '.jpg'"),
        ("thumbnail", "'thumb/' || CAST(p_partkey AS STRING) || '.jpg'"),
    ],
))
_add(Source(
    "shop_urls",
    _t("pages"),
    "pages",
    [
        ("associated_id", "page_id"),
        ("type", "CAST(1 AS BIGINT)"),
        ("site_id", "CAST(1 AS BIGINT)"),
        ("url", "url"),
    ],
))
_add(Source(
    "shop_option_variants",
    lambda t: t("part").select("p_size").distinct(),
    "(SELECT DISTINCT p_size FROM part) _s",
    [
        ("variant_id", "CAST(p_size AS BIGINT)"),
        ("variant_order", "CAST(50 - p_size AS BIGINT)"),
        ("name", "'V' || CAST(p_size AS STRING)"),
        ("general_size", "'G' || CAST(p_size % 5 AS STRING)"),
    ],
))
_add(Source(
    "shop_platform_link",
    _t("part"),
    "part",
    [
        ("id", "p_partkey"),
        ("site_id", "CAST(1 AS BIGINT)"),
        ("scs_id", "p_partkey + 1000000"),
        ("type", "CASE WHEN p_partkey % 4 = 0 THEN 'variant' ELSE 'product' END"),
    ],
))

# ---------------- e-commerce platform tables ----------------
_add(Source(
    "ecom_product",
    _t("part"),
    "part",
    [
        ("id", "p_partkey"),
        ("title", "p_name"),
        ("product_type", "p_type"),
        ("status", "CASE WHEN p_size % 2 = 0 THEN 'active' ELSE 'draft' END"),
    ],
))
_add(Source(
    "ecom_variant",
    _t("part"),
    "part",
    [
        ("product_id", "p_partkey"),
        ("inventory_item_id", "p_partkey"),
        ("sku", "CASE WHEN p_partkey % 10 = 0 THEN '' WHEN p_partkey % 5 = 0 THEN ' ' "
                "ELSE 'E' || CAST(p_partkey AS STRING) END"),
        ("option_1", "p_name"),
        ("option_2", "CAST(p_size AS STRING)"),
        ("option_3", "p_brand"),
    ],
))
_add(Source(
    "ecom_inventory_item",
    _t("part"),
    "part",
    [("id", "p_partkey"), ("cost", RETAIL)],
))
_add(Source(
    "ecom_inventory_level",
    _t("events"),
    "events",
    [
        ("inventory_item_id", "user_id"),
        ("available", "CAST(floor(value) AS BIGINT)"),
        ("updated_at", "ts"),
    ],
))
_add(Source("ecom_product_tag", _t("region"), "region",
            [("r_regionkey", "r_regionkey"), ("r_name", "r_name")]))
_add(Source("category_mapping", _t("nation"), "nation",
            [("n_nationkey", "n_nationkey"), ("n_name", "n_name"), ("n_regionkey", "n_regionkey")]))

# ---------------- load audit logs, one per source system ----------------
for _name, _flag in (("audit_pos", "A"), ("audit_shop", "N"), ("audit_ecom", "R")):
    _add(Source(
        _name,
        (lambda flag: lambda t: t("lineitem").where(F.col("l_returnflag") == flag))(_flag),
        f"lineitem WHERE l_returnflag = '{_flag}'",
        [("done", "l_shipdate"), ("rows_updated_or_inserted", "CAST(floor(l_extendedprice) AS BIGINT)")],
    ))


class Inputs:
    """Lazily built source-shaped DataFrames over one driver data folder.

    With ``staged_dir`` the inputs are read from Parquet tables written by
    ``stage_inputs`` (what a deployment reads: stored source tables) instead of
    being projected from the driver tables on every use.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, staged_dir: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.staged_dir = staged_dir.rstrip("/") if staged_dir else None
        self._tables: dict[str, DataFrame] = {}
        self._sources: dict[str, DataFrame] = {}
        self._latest: dict[tuple, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._sources:
            if self.staged_dir:
                self._sources[name] = self.spark.read.parquet(f"{self.staged_dir}/{name}")
            else:
                src = SOURCES[name]
                self._sources[name] = src.spark_base(self.table).selectExpr(*src.spark_exprs())
        return self._sources[name]

    def latest(self, name: str, keys: tuple[str, ...] = ("id",), ts: str = "updated_time") -> DataFrame:
        """Newest version per key of a change-log input, built once per
        ``Inputs`` so that every plan using it shares one exchange."""
        from stockroom.operators.dedup import latest_per_key

        memo = (name, keys, ts)
        if memo not in self._latest:
            self._latest[memo] = latest_per_key(self[name], list(keys), ts, CHANGE_ORDER)
        return self._latest[memo]

    def __getattr__(self, name: str) -> DataFrame:
        if name in SOURCES:
            return self[name]
        raise AttributeError(name)


def stage_inputs(spark: SparkSession, sf_dir: str, out_dir: str, files: int) -> None:
    """Write every source-shaped input as a Parquet table of ``files`` files
    under ``out_dir`` (one folder per input)."""
    inp = Inputs(spark, sf_dir)
    for name in SOURCES:
        inp[name].repartition(files).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{name}")
