"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Run parameters are pinned so that results are reproducible on the driver's
data: the run date ``AS_OF`` places the date spine over part of the order
history (so inner and outer spine joins differ), and ``MIN_ORDER_DATE`` keeps
part of the web-shop orders.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.plans import audit, calendar, catalog, category, channel, inventory, items, locations, marts, orders
from stockroom.plans.build import OBSERVED, MartTables, stored_violations
from stockroom.plans.sales_state import SalesState
from stockroom.sources.fixtures import CHANGE_ORDER, Inputs
from stockroom.sources.newest import NewestTable
from stockroom.sources.sinks import discard, materialize
from stockroom.session import ensure_checkpoint_dir

AS_OF = dt.date(2001, 12, 31)
MIN_ORDER_DATE = dt.date(1998, 1, 1)
# Days of the daily snapshot job whose history the inventory fact is built from.
RUN_DAYS = [dt.date(2001, 12, 5), dt.date(2001, 12, 12), dt.date(2001, 12, 19), dt.date(2001, 12, 26), AS_OF]
SPINE_FIRST, SPINE_LAST, SPINE_DAYS = calendar.spine_bounds(AS_OF)


class Mart:
    """Builds the dimensions and facts of one data folder once, lazily.

    Keys that read the inventory fact read it as a written table, as the source
    does (``tables``): it is built when its inputs have changed, once for all
    keys and sessions that share a catalog, and a lost executor recomputes from files.
    """

    def __init__(
        self, spark: SparkSession, sf_dir: str, materialize_facts: bool = True, staged_dir: str | None = None
    ):
        self.spark = spark
        self.inp = Inputs(spark, sf_dir, staged_dir)
        self.materialize_facts = materialize_facts
        self._cache: dict[str, DataFrame] = {}
        self.tables = MartTables(spark, sf_dir, {
            "date_dim": lambda: self.date_dim, "item_dim": lambda: self.item_dim, "location_dim": lambda: self.location_dim,
            "order_fact": lambda: self.order_fact, "inventory_fact": lambda: self.inventory_fact,
        }, f"{MIN_ORDER_DATE}|{RUN_DAYS}", staged_dir)

    def _get(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def date_dim(self) -> DataFrame:
        return self._get("date_dim", lambda: calendar.date_dim(self.spark, AS_OF))

    @property
    def item_dim(self) -> DataFrame:
        return self._get("item_dim", lambda: items.item_dim(self.inp))

    @property
    def location_dim(self) -> DataFrame:
        return self._get("location_dim", lambda: locations.location_dim(self.inp))

    @property
    def order_fact(self) -> DataFrame:
        return self._get("order_fact", lambda: orders.order_fact(self.inp, MIN_ORDER_DATE))

    @property
    def snapshot_history(self) -> DataFrame:
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/tables/snapshot-history-{uuid.uuid4().hex}"
        return self._get("snapshot_history", lambda: inventory.stock_snapshot_history(self.inp, RUN_DAYS, path))

    @property
    def inventory_fact(self) -> DataFrame:
        return self._get("inventory_fact", lambda: inventory.inventory_fact(self.inp, self.snapshot_history))

    @property
    def inventory_fact_table(self) -> DataFrame:
        if not self.materialize_facts:
            return self.inventory_fact
        return self._get("inventory_fact_table", lambda: self.tables.table("inventory_fact"))

    @property
    def inventory_intervals(self) -> DataFrame:
        return self._get("inventory_intervals", lambda: marts.inventory_intervals(self.inventory_fact_table))

    @property
    def sales_weekly(self) -> DataFrame:
        return self._get("sales_weekly", lambda: marts.sales_weekly(self.date_dim, self.order_fact, self.item_dim))


def _date_dimension(m: Mart) -> DataFrame:
    # run date = the latest day present in the landed order lines
    anchor = m.inp.pos_order_line_history.agg(F.max(F.to_date("updated_time")).alias("as_of"))
    return calendar.date_dim_for_anchor(anchor)


def _own_place(m: Mart, name: str) -> str:
    return f"{ensure_checkpoint_dir(m.spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def _stock_snapshot_daily(m: Mart) -> DataFrame:
    """The daily job, run by run, from an empty state."""
    place = _own_place(m, "snapshot-daily")
    job = inventory.SnapshotJob(m.inp, f"stockroom_daily_{place[-16:]}", place)
    for day in RUN_DAYS:
        job.run(day)
    return job.history()


def _pos_items_newest_stored(m: Mart) -> DataFrame:
    """The newest item rows, kept since the first run day and advanced to the last day of the log."""
    place = _own_place(m, "newest-items")
    kept = NewestTable(
        m.spark, f"stockroom_newest_{place[-16:]}.pos_items", place, ["id"], "updated_time", CHANGE_ORDER,
        ["updated_time", "category_id", "custom_sku", "avg_cost", "description"],
    )
    log = m.inp.pos_item_history
    kept.advance(log.where(F.to_date("updated_time") <= F.lit(RUN_DAYS[0])))
    return kept.advance(log)


def _sales_weekly_from_state(m: Mart) -> DataFrame:
    """The state of all days, the last run day's week added once more, and the weeks from it."""
    state = SalesState(m.spark, _own_place(m, "sales-state"))
    sold = materialize(m.order_fact, "orders")  # read by both runs
    state.add(m.date_dim, sold)
    last = F.date_trunc("week", F.lit(AS_OF)).cast("date")
    state.add(m.date_dim, sold.where(F.col("date").between(last, F.date_add(last, 6))))
    discard(sold)  # the state holds its days
    return state.weekly(m.item_dim)


_BUILDERS: dict[str, Callable[[Mart], DataFrame]] = {
    "date_dimension": _date_dimension,
    "category_levels_ranked": lambda m: category.category_levels_ranked(m.inp),
    "item_category_distinct": lambda m: category.item_category_distinct(m.inp),
    "product_type_pairs": lambda m: category.product_type_pairs(m.inp),
    "active_product_types": lambda m: category.active_product_types(m.inp),
    "table_passthrough": lambda m: category.table_passthrough(m.inp),
    "product_tag_passthrough": lambda m: category.table_passthrough(m.inp, "ecom_product_tag"),
    "pos_items": lambda m: items.pos_items(m.inp),
    "shop_brands": lambda m: items.shop_brands(m.inp),
    "shop_category_ids": lambda m: items.shop_category_ids(m.inp),
    "shop_options": lambda m: items.shop_options(m.inp),
    "shop_sizes": lambda m: items.shop_sizes(m.inp),
    "shop_items": lambda m: items.shop_items(m.inp),
    "item_dim": lambda m: m.item_dim,
    "vendor_sku": lambda m: items.vendor_sku(m.inp),
    "location_latest": lambda m: locations.location_latest(m.inp),
    "location_dim": lambda m: m.location_dim,
    "stock_snapshot": lambda m: inventory.stock_snapshot(m.inp, AS_OF),
    "stock_snapshot_history": lambda m: m.snapshot_history,
    "stock_snapshot_daily": _stock_snapshot_daily,
    "pos_items_newest_stored": _pos_items_newest_stored,
    "moves_last_of_day": lambda m: inventory.moves_last_of_day(m.inp),
    "monthly_avg_cost": lambda m: inventory.monthly_avg_cost(m.inp),
    "cost_intervals": lambda m: inventory.cost_intervals(m.inp),
    "cost_interval_for_option": lambda m: inventory.cost_interval_for_option(m.inp),
    "ledger_for_option": lambda m: inventory.ledger_for_option(m.inp),
    "inventory_costed": lambda m: inventory.inventory_costed(m.inp),
    "inventory_costed_per_option": lambda m: inventory.inventory_costed(m.inp, boundary="per_key"),
    "inventory_fact": lambda m: m.inventory_fact,
    "pos_order_lines_latest": lambda m: orders.pos_order_lines_latest(m.inp),
    "pos_orders": lambda m: orders.pos_orders(m.inp),
    "shop_orders": lambda m: orders.shop_orders(m.inp, MIN_ORDER_DATE),
    "order_fact": lambda m: m.order_fact,
    "discounted_orders_ranked": lambda m: orders.discounted_orders_ranked(m.inp),
    "inventory_intervals": lambda m: m.inventory_intervals,
    "inventory_on_spine": lambda m: marts.inventory_on_spine(
        m.date_dim, m.inventory_intervals, (SPINE_FIRST, SPINE_LAST)
    ),
    "inventory_weekly": lambda m: marts.inventory_weekly(
        m.date_dim, m.inventory_intervals, m.item_dim, m.location_dim, (SPINE_FIRST, SPINE_LAST)
    ),
    "sales_weekly": lambda m: m.sales_weekly,
    "discounted_sales_by_item": lambda m: marts.discounted_sales_by_item(m.date_dim, m.order_fact, m.item_dim),
    "view_lookup_distinct": lambda m: marts.view_lookup_distinct(m.sales_weekly),
    "channel_inventory": lambda m: channel.channel_inventory(m.inp),
    "product_info": lambda m: catalog.product_info(m.inp),
    "option_info": lambda m: catalog.option_info(m.inp),
    "audit_monthly_avg": lambda m: audit.audit_monthly_avg(m.inp),
    "required_column_violations": lambda m: stored_violations(m.spark, {t: m.tables.name(t) for t in OBSERVED}),
    "sales_weekly_from_state": _sales_weekly_from_state,
    "sales_weekly_view": lambda m: m.tables.view("sales_weekly"),
    "inventory_weekly_view": lambda m: m.tables.view("inventory_weekly"),
}


def build(name: str, spark: SparkSession, sf_dir: str, staged_dir: str | None = None) -> DataFrame:
    """The DataFrame of one query key; inputs projected from ``sf_dir`` or, with
    ``staged_dir``, read from inputs staged there by ``stage_inputs``."""
    # epoch and date conversions are defined in UTC
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return _BUILDERS[name](Mart(spark, sf_dir, staged_dir=staged_dir))


def _runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(name, spark, sf_dir)

    run.__name__ = name
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _runner(k) for k in _BUILDERS}
