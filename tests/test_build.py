"""The mart as catalog tables and views: same rows as the queries, new rows after a replace."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from stockroom.compare import spark_rows
from stockroom.plans.build import MartTables, build_mart, put_table, stored_violations
from stockroom.plans.inventory import SnapshotJob, stock_snapshot, stock_snapshots
from stockroom.plans.registry import AS_OF, MIN_ORDER_DATE, QUERIES, RUN_DAYS, Mart
from stockroom.plans.schemas import INVENTORY_FACT, ORDER_FACT
from stockroom.sources.fixtures import Inputs
from stockroom.sources.newest import NewestTable
from stockroom.sources.sinks import replace_table, table_properties

from paths import SF_SMALL


def test_views_follow_their_tables_in_every_session(spark, tmp_dir):
    tables = build_mart(spark, SF_SMALL, f"{tmp_dir}/mart", RUN_DAYS, MIN_ORDER_DATE)
    other = spark.newSession()
    for key in ("sales_weekly", "inventory_weekly"):
        want = spark_rows(QUERIES[key](spark, SF_SMALL))
        assert spark_rows(spark.table(f"stockroom.{key}")) == want, key
        assert spark_rows(other.table(f"stockroom.{key}")) == want, key
    assert spark.table("stockroom.inventory_fact").count() == QUERIES["inventory_fact"](spark, SF_SMALL).count()
    half = spark.table(tables["order_fact"]).where(F.xxhash64("orderuuid") % 2 == 0)
    replace_table(half, tables["order_fact"], f"{tmp_dir}/mart/order_fact", ORDER_FACT)
    replace_table(spark.createDataFrame([], INVENTORY_FACT), tables["inventory_fact"], f"{tmp_dir}/mart/inventory_fact", INVENTORY_FACT)
    sales = other.table("stockroom.sales_weekly")
    assert 0 < sales.count() < len(want[1]) and sales.agg(F.sum("qtysold")).first() == spark.table("stockroom.sales_weekly").agg(F.sum("qtysold")).first()
    for s in (spark, other):  # no stock: the spine's uncovered days only
        left = s.table("stockroom.inventory_weekly")
        assert left.count() == left.where("itemuuid IS NULL").count() > 0


def test_weekly_inventory_view_with_ties_nulls_and_one_hot_item(spark, tmp_dir):
    """The signed parts of the view against the intervals of the fact."""
    import random

    from stockroom.plans import calendar, marts

    rng = random.Random(4)
    build_mart(spark, SF_SMALL, f"{tmp_dir}/mart", RUN_DAYS[:1], MIN_ORDER_DATE, database="stockroom_ties")
    rows = []
    for i in range(900):
        item = None if rng.random() < 0.02 else ("pos/1" if i < 300 else f"shop/{rng.randrange(40)}/1")
        day = None if rng.random() < 0.02 else dt.date(2001, 12, 1) + dt.timedelta(days=rng.randrange(40))
        qoh = rng.choice([None, 1, 2])
        rows.append((day, rng.choice(["a", None]), item, qoh, None, None if qoh is None else rng.randrange(9), rng.choice(["1", "2", None]), "c", "pos"))
    rows += rows[:60]  # records repeated in full
    fact = spark.createDataFrame(rows, "date date, sku string, itemuuid string, qoh bigint, backorder bigint, cost int, locationid string, categoryid string, source string")
    replace_table(fact, "stockroom_ties.inventory_fact", f"{tmp_dir}/mart/inventory_fact", INVENTORY_FACT)
    stored = spark.table("stockroom_ties.inventory_fact")
    first, last, _ = calendar.spine_bounds(RUN_DAYS[0])
    t = lambda n: spark.table(f"stockroom_ties.{n}")
    want = marts.inventory_weekly(t("date_dim"), marts.inventory_intervals(stored), t("item_dim"), t("location_dim"), (first, last))
    assert spark_rows(t("inventory_weekly")) == spark_rows(want)


def test_rebuilding_does_not_duplicate(spark, tmp_dir):
    out = f"{tmp_dir}/mart"
    counts = []
    for _ in range(2):
        tables = build_mart(spark, SF_SMALL, out, RUN_DAYS[:2], MIN_ORDER_DATE)
        counts.append([spark.read.parquet(f"{out}/stock_snapshot_history").count()]
                      + [spark.table(t).count() for t in tables.values()])
    assert counts[0] == counts[1]


def test_mart_tables_are_built_once_per_version_of_the_inputs(spark):
    m = Mart(spark, SF_SMALL)
    name = m.tables.name("inventory_fact")
    version = table_properties(spark, name)["version"]
    again = Mart(spark, SF_SMALL)
    assert again.tables.name("inventory_fact") == name and table_properties(spark, name)["version"] == version
    # keys over the built fact read its files and nothing of the histories
    for key in ("inventory_intervals", "inventory_on_spine", "inventory_weekly"):
        plan = QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "lineitem.parquet" not in plan.split("item_dim")[0] or key == "inventory_weekly"
        assert "events.parquet" not in plan or key == "inventory_weekly", key
    changed = MartTables(spark, SF_SMALL, again.tables.builders, "other parameters")
    changed.name("inventory_fact")
    assert table_properties(spark, name)["version"] != version


def test_null_counts_are_those_of_the_write(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS stockroom_counts")
    rows = [("1", "Main", "UTC", "pos"), ("2", None, "UTC", "shop"), ("3", None, None, "shop")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    put_table(df, "location_dim", "stockroom_counts.location_dim", f"{tmp_dir}/loc", inputs="v1")
    kept = table_properties(spark, "stockroom_counts.location_dim")
    assert kept["rows"] == "3" and kept["nulls.locationname"] == "2" and kept["inputs"] == "v1"
    got = stored_violations(spark, {"location_dim": "stockroom_counts.location_dim"})
    assert [tuple(r) for r in got.collect()] == [("location_dim", "locationname", 2)]


# ---------------------------------------------------------------- snapshots
def _scans(df, table: str) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count(f"{table}.parquet")


def test_snapshots_of_several_days_take_one_scan_of_each_history(spark):
    inp = Inputs(spark, SF_SMALL)
    many = stock_snapshots(inp, RUN_DAYS)
    want = stock_snapshot(inp, RUN_DAYS[0])
    for day in RUN_DAYS[1:]:
        want = want.unionAll(stock_snapshot(inp, day))
    for table in ("events", "lineitem"):
        assert _scans(many, table) == _scans(stock_snapshot(inp, AS_OF), table) < _scans(want, table)
    assert spark_rows(many) == spark_rows(want)


def test_daily_runs_equal_the_history_and_read_new_changes_only(spark, tmp_dir):
    inp = Inputs(spark, SF_SMALL)
    job = SnapshotJob(inp, "stockroom_job", f"{tmp_dir}/job")
    for day in RUN_DAYS[:3]:
        job.run(day)
    got = spark_rows(job.run(RUN_DAYS[2]))  # a repeated run changes nothing
    assert got == spark_rows(stock_snapshots(inp, RUN_DAYS[:3]))
    plan = job.changes(inp.pos_item_history, RUN_DAYS[3], RUN_DAYS[2])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    with pytest.raises(ValueError):
        job.run(RUN_DAYS[0])


def test_newest_table_reads_new_changes_only(spark, tmp_dir):
    ts = lambda d: dt.datetime(2024, 1, d)
    rows = [(1, ts(1), 1, "a"), (1, ts(3), 1, "b"), (2, ts(2), 1, "c"), (3, None, 1, "d"), (3, ts(1), 9, "e")]
    late = [(2, ts(3), 1, "f"), (1, ts(3), 2, "g"), (4, ts(5), 1, "h"), (4, ts(5), 0, "i"), (2, None, 1, "j")]
    schema = "id int, updated_time timestamp_ntz, seq int, v string"
    log = spark.createDataFrame(rows + late, schema)
    kept = NewestTable(spark, "stockroom_newest.t", f"{tmp_dir}/newest", ["id"], "updated_time", ["seq"], ["v"])
    kept.advance(spark.createDataFrame(rows, schema))
    assert kept.high_water_mark() == ts(3)
    assert kept.new_changes(log).count() == 7  # from the mark on, and rows without a time
    want = sorted([(1, "g"), (2, "j"), (3, "d"), (4, "h")])
    assert sorted(tuple(r) for r in kept.advance(log).collect()) == want
    assert sorted(tuple(r) for r in kept.advance(log).collect()) == want


# ---------------------------------------------------------------- weekly sales state
def test_a_week_is_rebuilt_from_its_own_days(spark, tmp_dir):
    from stockroom.plans import marts
    from stockroom.plans.calendar import date_dim
    from stockroom.plans.sales_state import SalesState

    d = lambda n: dt.date(2001, 11, n)
    schema = "date date, itemuuid string, orderuuid string, qty_sold bigint, price decimal(10,2), discount decimal(38,0), locationid string, source string"
    rows = [
        (d(5), "i1", "o1", 1, 10, 1, "1", "pos"), (d(6), "i1", "o1", 2, 20, 2, "1", "pos"), (d(7), "i1", "o2", 3, 30, -2, "1", "pos"),
        (d(7), "i1", None, 1, 5, None, "1", "pos"), (d(8), "i2", "o1", 1, 10, None, None, "shop"), (d(12), "i1", "o1", 4, 40, 0, "1", "pos"),
        (d(13), None, "o9", 4, 40, -1, "1", "pos"), (d(13), None, "o9", 4, 40, -1, "1", "pos"), (d(14), None, "o8", 1, 4, 0, "1", "pos"),
    ]
    from decimal import Decimal

    orders = spark.createDataFrame(
        [(a, b, c, q, Decimal(p), None if x is None else Decimal(x), loc, s) for a, b, c, q, p, x, loc, s in rows], schema
    )
    items = spark.createDataFrame([("s", "i1", "b", "v", "c", "d", "red", "L", "x", "pos")] * 2, Mart(spark, SF_SMALL).item_dim.schema)
    spine = date_dim(spark, AS_OF)
    state = SalesState(spark, f"{tmp_dir}/state")
    state.add(spine, orders.where(F.col("date") != d(7)))
    state.add(spine, orders.where(F.col("date") == d(7)))  # a new day
    state.add(spine, orders.where(F.col("date") == d(7)))  # and again
    want = marts.sales_weekly(spine, orders, items)
    assert spark_rows(state.weekly(items)) == spark_rows(want)
    assert state.weekly(items).schema.simpleString() == want.schema.simpleString()
    week = state.weekly(items, [d(11)])
    assert spark_rows(week) == spark_rows(want.where(F.col("weekending") == d(11)))
    p = week._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*weekending#\d+ = 2001-11-11", p), p


def test_a_view_builds_the_tables_that_it_reads(spark):
    built = []
    m = Mart(spark, SF_SMALL)
    tables = MartTables(spark, SF_SMALL, {
        k: (lambda k=k, b=b: built.append(k) or b()) for k, b in m.tables.builders.items()
    }, "parameters of the test of views")
    assert tables.view("sales_weekly").count() > 0
    assert sorted(built) == ["date_dim", "item_dim", "order_fact"]


def test_item_versions_of_a_snapshot_are_one_a_run(spark):
    """An item that changes every day gives the run days' rows only, kept where the history is read."""
    frame = stock_snapshots(Inputs(spark, SF_SMALL), RUN_DAYS[:3])
    p = frame._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"WindowGroupLimit \[(.*?)\]", p)
    assert any("_from" in w and "id#" in w for w in windows), windows
    assert re.search(r"coalesce\(CASE WHEN .* AS _from|CASE WHEN .*2001-12-05.* AS _from", p), p


def test_both_runs_of_the_sales_state_read_one_order_table(spark, monkeypatch):
    from stockroom.plans import sales_state

    given = []
    monkeypatch.setattr(sales_state.SalesState, "add", lambda self, spine, orders: given.append(
        orders._jdf.queryExecution().executedPlan().toString()
    ))
    monkeypatch.setattr(sales_state.SalesState, "weekly", lambda self, items, weeks=None: None)
    QUERIES["sales_weekly_from_state"](spark, SF_SMALL)
    assert len(given) == 2 and not [p for p in given if "lineitem" in p or "Exchange" in p]


def _sold(spark, rows):
    schema = "date date, itemuuid string, orderuuid string, qty_sold bigint, price decimal(10,2), discount decimal(38,0), locationid string, source string"
    return spark.createDataFrame(rows, schema)


def _hot_sales(spark):
    """One item has most rows, in several weeks and places; some have no item, an order spans two days."""
    from decimal import Decimal

    rows = []
    for i in range(600):
        day = dt.date(2001, 10, 1) + dt.timedelta(days=i % 60)
        item = None if i % 11 == 0 else "i0" if i % 3 else f"i{i % 7}"
        rows.append((day, item, f"o{i // 2}" if i % 13 else None, i % 5, Decimal(i % 9), None if i % 4 == 0 else Decimal(i % 6 - 2), str(i % 2), "pos"))
    return _sold(spark, rows)


def _two_rows_each(spark, items):
    return spark.createDataFrame(
        [("s", i, "b", "v", "c", "d", "red", size, "x", "pos") for i in items for size in ("L", "L", "M")], Mart(spark, SF_SMALL).item_dim.schema
    )


def test_rows_of_a_hot_item_are_dealt_by_their_groups(spark, tmp_dir, monkeypatch):
    from stockroom.plans import marts, sales_state
    from stockroom.plans.calendar import date_dim

    orders, spine = _hot_sales(spark), date_dim(spark, AS_OF)
    items = _two_rows_each(spark, ["i0", "i1", "i2", "i3", "i9"])
    state = sales_state.SalesState(spark, f"{tmp_dir}/state-hot")
    state.add(spine, orders)
    want = spark_rows(marts.sales_weekly(spine, orders, items))
    hot, parts = state._hot_items(state.rows())
    assert "i0" in hot and parts > 1
    assert spark_rows(state.weekly(items)) == want
    monkeypatch.setattr(sales_state.SalesState, "_hot_items", lambda self, rows: ([], 3))
    assert spark_rows(state.weekly(items)) == want
    monkeypatch.setattr(sales_state.SalesState, "_hot_items", lambda self, rows: ([f"i{k}" for k in range(9)], 5))
    assert spark_rows(state.weekly(items)) == want


def test_rows_of_the_state_move_once_for_their_sums_and_items(spark, tmp_dir):
    from stockroom.plans.calendar import date_dim
    from stockroom.plans.sales_state import SalesState

    state = SalesState(spark, f"{tmp_dir}/state-once")
    state.add(date_dim(spark, AS_OF), _hot_sales(spark))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = state.weekly(_two_rows_each(spark, ["i0", "i1"]))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*itemuuid", p)) == 1, p


def test_a_large_week_is_written_in_parts(spark, tmp_dir):
    """The rows are dealt once, to the files of their week: as many as its rows need."""
    from stockroom.plans.calendar import date_dim
    from stockroom.plans.sales_state import daily_orders

    orders, spine = _hot_sales(spark), date_dim(spark, AS_OF)
    whole, dealt = daily_orders(spine, orders), daily_orders(spine, orders, week_rows=20)
    assert spark_rows(whole) == spark_rows(dealt)
    week = F.col("weekending") == dt.date(2001, 10, 14)
    tasks = lambda df: df.where(week).select(F.spark_partition_id()).distinct().count()
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert tasks(whole) == 1 and 1 < tasks(dealt) <= 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_the_order_table_of_the_state_does_not_stay(spark):
    from pathlib import Path

    tables = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "tables"
    before = {p.name for p in tables.glob("orders-*")}
    assert QUERIES["sales_weekly_from_state"](spark, SF_SMALL).count() > 0
    assert {p.name for p in tables.glob("orders-*")} <= before
