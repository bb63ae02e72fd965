"""Stock snapshot, web-shop inventory with as-of costs, and the inventory fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockroom.functions import ITEM_UUID_SEP, as_text, epoch_to_date, epoch_to_timestamp, item_uuid, month_end, typed_null
from stockroom.operators.conform import conform, union_conformed
from stockroom.operators.dedup import latest_per_key, latest_per_key_per_day
from stockroom.operators.intervals import asof_carry, asof_join, lead_month, month_successors, start_after_previous
from stockroom.plans.items import shop_category_ids
from stockroom.plans.schemas import INVENTORY_FACT, POS, SHOP, STOCK_SNAPSHOT
from stockroom.sources.fixtures import CHANGE_ORDER, Inputs
from stockroom.sources.newest import NewestTable
from stockroom.sources.sinks import append_snapshot, read_table

# Option whose cost history the source's inspection queries look at.
INSPECTED_OPTION = 176


def stock_snapshot(inp: Inputs, as_of: dt.date | None = None) -> DataFrame:
    """Daily snapshot run on ``as_of`` (default: the session's current date): of
    the changes up to that day, the last stock row of every item, shop and day
    with the newest item attributes; row id ``as_of/shop/item``."""
    run_day = F.current_date() if as_of is None else F.lit(as_of)
    upto = F.to_date("updated_time") <= run_day
    item = latest_per_key(
        inp.pos_item_history.where(upto), ["id"], "updated_time", CHANGE_ORDER,
        ["category_id", "custom_sku", "avg_cost", "description"],
    )
    stock = latest_per_key_per_day(
        inp.pos_item_shop_history.where(upto), ["id", "item_id", "shop_id"], "updated_time", "inventorydate",
        CHANGE_ORDER, ["qoh", "backorder"],
    )
    # a left join whose right side is filtered to its newest rows: an inner join
    j = stock.join(item.withColumnRenamed("id", "_iid"), F.col("item_id") == F.col("_iid"))
    return _snapshot_rows(j, run_day)


def stock_snapshots(inp: Inputs, run_days: Sequence[dt.date]) -> DataFrame:
    """The snapshots of several run days, with one pass over each history.

    The last stock row of an item, shop and day is in the snapshot of every run
    from that day on.  Of an item's versions since the run before, the last is
    valid from the run on until the next run with a change.  Both are spread to the run
    days they cover and meet there.
    """
    days = sorted(set(run_days))
    runs = F.array(*[F.lit(d) for d in days])
    changed = F.to_date("updated_time")
    upto = changed <= F.lit(days[-1])
    first_run = F.coalesce(*[F.when(changed <= F.lit(d), F.lit(d)) for d in days])
    # one row an item and run, kept where the history is read
    versions = latest_per_key(
        inp.pos_item_history.where(upto).withColumn("_from", first_run), ["id", "_from"], "updated_time", CHANGE_ORDER,
        ["category_id", "custom_sku", "avg_cost", "description"],
    )
    until = F.lead("_from").over(Window.partitionBy("id").orderBy("_from"))
    valid = versions.withColumn("_until", until)
    covered = F.filter(runs, lambda d: (d >= F.col("_from")) & (F.col("_until").isNull() | (d < F.col("_until"))))
    item = valid.withColumn("_run", F.explode(covered)).withColumnRenamed("id", "_iid")
    stock = latest_per_key_per_day(
        inp.pos_item_shop_history.where(upto), ["id", "item_id", "shop_id"], "updated_time", "inventorydate",
        CHANGE_ORDER, ["qoh", "backorder"],
    ).withColumn("run_day", F.explode(F.filter(runs, lambda d: d >= F.col("inventorydate"))))
    j = stock.join(item, (F.col("item_id") == F.col("_iid")) & (F.col("run_day") == F.col("_run")))
    return _snapshot_rows(j, F.col("run_day"))


def _snapshot_rows(joined: DataFrame, run_day: Column) -> DataFrame:
    """Stock rows with their item's attributes, as rows of the snapshot of ``run_day``."""
    return conform(
        joined.select(
            F.concat(as_text(run_day), F.lit("/"), as_text("shop_id"), F.lit("/"), as_text("item_id")),
            run_day,
            as_text("inventorydate"),
            "custom_sku",
            as_text("item_id"),
            "qoh", "backorder", "avg_cost",
            as_text("shop_id"),
            as_text("category_id"),
        ),
        STOCK_SNAPSHOT,
    )


def stock_snapshot_history(inp: Inputs, run_days: Sequence[dt.date], path: str) -> DataFrame:
    """The history of the runs on ``run_days``: their snapshots appended to the
    table at ``path``, read back from there."""
    append_snapshot(stock_snapshots(inp, run_days), path, STOCK_SNAPSHOT)
    return read_table(inp.spark, path).select(*[f.name for f in STOCK_SNAPSHOT.fields])


class SnapshotJob:
    """The daily snapshot as an increment: a run reads the changes since the last one.

    It keeps the newest version of every item (``NewestTable``) and the last stock
    row of every item, shop and day, a table partitioned by day.  A run reads the
    changes from the day of the last run on (that day may have gone on after
    it), replaces those days' rows, advances the items and writes its snapshot,
    which is that of ``stock_snapshot`` for the day.  A run may be repeated.
    """

    def __init__(self, inp: Inputs, database: str, location: str):
        self.inp, self.spark = inp, inp.spark
        location = location.rstrip("/")
        self.days_path, self.history_path = f"{location}/stock_days", f"{location}/stock_snapshot_history"
        self.items = NewestTable(
            self.spark, f"{database}.snapshot_items", f"{location}/items", ["id"], "updated_time", CHANGE_ORDER,
            ["category_id", "custom_sku", "avg_cost", "description"],
        )
        self._last: dt.date | None = None

    def changes(self, history: DataFrame, day: dt.date, last: dt.date | None) -> DataFrame:
        """The rows of a change log that a run on ``day`` reads after one on ``last``."""
        t = F.col("updated_time")
        some = history.where(t < F.lit(dt.datetime.combine(day + dt.timedelta(days=1), dt.time())).cast("timestamp_ntz"))
        return some if last is None else some.where(t >= F.lit(dt.datetime.combine(last, dt.time())).cast("timestamp_ntz"))

    def run(self, day: dt.date) -> DataFrame:
        """Write the snapshot of ``day``; runs are in order of days."""
        last = self._last
        if last is not None and day < last:
            raise ValueError(f"a run on {day} after one on {last}")
        stock = latest_per_key_per_day(
            self.changes(self.inp.pos_item_shop_history, day, last), ["id", "item_id", "shop_id"], "updated_time",
            "inventorydate", CHANGE_ORDER, ["qoh", "backorder"],
        )
        append_snapshot(stock, self.days_path, partition_col="inventorydate")
        item = self.items.advance(self.changes(self.inp.pos_item_history, day, last)).withColumnRenamed("id", "_iid")
        kept = self.spark.read.schema(stock.schema).parquet(self.days_path)
        j = kept.join(item, F.col("item_id") == F.col("_iid"))
        append_snapshot(_snapshot_rows(j, F.lit(day)), self.history_path, STOCK_SNAPSHOT)
        self._last = day
        return self.history()

    def history(self) -> DataFrame:
        return read_table(self.spark, self.history_path).select(*[f.name for f in STOCK_SNAPSHOT.fields])


def moves_last_of_day(inp: Inputs) -> DataFrame:
    """Last inventory move of each option and day."""
    last = latest_per_key_per_day(
        inp.shop_inventory_move, ["option_id"], "changetime", "inventorydate", CHANGE_ORDER,
        ["oldinv", "newinv"],
    )
    return last.select(
        "oldinv", "inventorydate", "option_id", F.col("newinv").alias("qoh"),
        F.lit(1).alias("inventoryrownumber"),
    )


def monthly_avg_cost(inp: Inputs) -> DataFrame:
    """Average ledger cost per option and month (month = month end of the
    epoch-second stamp)."""
    led = inp.shop_cost_ledger
    return led.groupBy(
        "prod_option_id", month_end(epoch_to_date("stamped")).alias("monthending")
    ).agg(F.avg("cost_price").alias("monthlycostavg"))


def cost_intervals(inp: Inputs, option_id: int | None = None, boundary: str = "global") -> DataFrame:
    """Validity interval ``[startmonth, monthending]`` of every monthly cost.

    ``previousmonthending`` is the next row in (month DESC, option DESC) order
    over all options, as in the source; see ``lead_month``.  With ``option_id``
    only that option's ledger is averaged; the month frame stays global.
    ``boundary="per_key"`` takes the option's own next older month.
    """
    months = inp.shop_cost_ledger.select("prod_option_id", month_end(epoch_to_date("stamped")).alias("monthending"))
    successors = month_successors(months, "monthending", "prod_option_id")
    m = monthly_avg_cost(inp)
    if option_id is not None:
        m = m.where(F.col("prod_option_id") == option_id)
    m = lead_month(m, "monthending", "prod_option_id", "previousmonthending", successors, boundary)
    return m.select(
        "prod_option_id", "monthending", "monthlycostavg", "previousmonthending",
        start_after_previous("previousmonthending", "monthending").alias("startmonth"),
    )


def cost_interval_for_option(inp: Inputs, option_id: int = INSPECTED_OPTION) -> DataFrame:
    return cost_intervals(inp, option_id)


def ledger_for_option(inp: Inputs, option_id: int = INSPECTED_OPTION) -> DataFrame:
    led = inp.shop_cost_ledger.where(F.col("prod_option_id") == option_id)
    return led.select("*", epoch_to_timestamp("stamped").alias("stamped_time"))


def inventory_costed(inp: Inputs, site_id: int = 1, sep: str = ITEM_UUID_SEP, boundary: str = "global") -> DataFrame:
    """Last move per option and day with the cost valid on that day, category
    and site product name.

    With ``boundary="per_key"`` a cost is valid since the option's own cost before,
    so an option's intervals do not overlap and may be years long."""
    moves = moves_last_of_day(inp)
    opts = inp.shop_product_options.select(
        F.col("prod_id").alias("uuid"), "prod_id", "prod_option_id", "option_sku"
    )
    costs = cost_intervals(inp, boundary=boundary).select(
        F.col("prod_option_id").alias("_c_opt"), "monthending", "startmonth", "monthlycostavg"
    )
    cat = shop_category_ids(inp).select(F.col("prod_id").alias("_cat_prod"), "categoryid")
    pss = inp.shop_products_site.where(F.col("site_id") == site_id).select(
        F.col("prod_id").alias("_s_prod"), "prod_name"
    )
    j = moves.join(opts, opts["prod_option_id"] == moves["option_id"])
    asof = asof_carry if boundary == "per_key" else asof_join
    j = asof(j, costs, [("prod_option_id", "_c_opt")], "inventorydate", "startmonth", "monthending")
    j = j.join(cat, j["prod_id"] == cat["_cat_prod"]).join(pss, j["prod_id"] == pss["_s_prod"], "left")
    return j.select(
        "inventorydate", "option_id", "qoh", "inventoryrownumber", "uuid", "prod_id", "prod_option_id",
        "categoryid", "option_sku", "prod_name", "monthlycostavg",
    )


def inventory_fact(inp: Inputs, snapshot_history: DataFrame, sep: str = ITEM_UUID_SEP) -> DataFrame:
    """Web-shop daily stock with as-of cost, plus the point-of-sale snapshot history."""
    shop = inventory_costed(inp, sep=sep).select(
        "inventorydate", "option_sku", item_uuid(SHOP, "prod_id", "prod_option_id", sep=sep), "qoh",
        typed_null("bigint"), "monthlycostavg", typed_null("string"), "categoryid", F.lit(SHOP),
    )
    pos = snapshot_history.select(
        "insertdate", "sku", F.concat(F.lit(POS), F.lit(sep), "itemuuid"), "qoh", "backorder", "cost",
        "locationid", as_text("categoryid"), F.lit(POS),
    )
    return union_conformed(INVENTORY_FACT, shop, pos)
