"""Edge cases the driver data lacks, and equivalence of the literal and the
distributed forms of the interval operators."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stockroom.functions import (
    avg_to_bigint,
    day_of_week0,
    item_uuid,
    month_abbr,
    path_level,
    to_whole_number,
    week_ending,
)
from stockroom.operators.conform import conform, required_column_violations, union_conformed
from stockroom.operators.dedup import (
    latest_per_key,
    latest_per_key_per_day,
    newest_first,
    rank_versions,
)
from stockroom.operators.intervals import asof_carry, asof_join, lead_across_groups, lead_month, spread_over_spine
from stockroom.plans.calendar import date_dim, spine_bounds

from literal_forms import (
    asof_join_literal,
    inventory_weekly_by_day,
    lead_across_groups_literal,
    lead_month_literal,
    rank_versions_window,
    sales_weekly_by_row,
    spine_join_literal,
)

D = dt.date
T = dt.datetime


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- scalars
def test_path_levels_trim_and_missing_levels(spark):
    df = spark.createDataFrame([(" $.A./ B /C $",), ("only",), (None,)], "name string")
    out = df.select(
        path_level("name", 1, trim_whole_first=True).alias("whole"),
        path_level("name", 1).alias("part"),
        path_level("name", 2).alias("l2"),
        path_level("name", 3).alias("l3"),
        path_level("name", 5).alias("l5"),
    ).collect()
    assert tuple(out[0]) == ("A.", "A", "B", "C", "")
    assert tuple(out[1]) == ("only", "only", "", "", "")
    assert tuple(out[2]) == (None, None, None, None, None)


def test_item_uuid_null_part_gives_null(spark):
    df = spark.createDataFrame([(1, 2), (1, None)], "a bigint, b bigint")
    assert [r[0] for r in df.select(item_uuid("shop", "a", "b")).collect()] == ["shop/1/2", None]


def test_week_ending_is_sunday_and_sunday_maps_to_itself(spark):
    days = [D(2024, 12, 29), D(2024, 12, 30), D(2025, 1, 4), D(2025, 1, 5)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    out = [r[0] for r in df.select(week_ending("d")).collect()]
    assert out == [D(2024, 12, 29), D(2025, 1, 5), D(2025, 1, 5), D(2025, 1, 5)]


def test_day_of_week_zero_is_sunday_and_month_abbr(spark):
    df = spark.createDataFrame([(D(2024, 12, 29),), (D(2024, 2, 3),)], "d date")
    out = df.select(day_of_week0("d"), month_abbr("d")).collect()
    assert tuple(out[0]) == ("0", "Dec")
    assert tuple(out[1]) == ("6", "Feb")


def test_rounding_half_away_from_zero(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (2, -2), (2, -3)], "g int, v bigint")
    got = dict(df.groupBy("g").agg(avg_to_bigint("v")).collect())
    assert got == {1: 3, 2: -3}
    dec = spark.createDataFrame([(Decimal("2.5"),), (Decimal("-2.5"),)], "x decimal(10,2)")
    assert [r[0] for r in dec.select(to_whole_number("x")).collect()] == [Decimal(3), Decimal(-3)]


# ---------------------------------------------------------------- dedup
HIST = [
    # key, ts, seq, value
    (1, T(2024, 1, 1, 10), "a", "old"),
    (1, T(2024, 1, 2, 10), "a", "new-a"),
    (1, T(2024, 1, 2, 10), "b", "new-b"),   # tie on ts: higher seq wins
    (2, None, "a", "null-ts"),             # DESC NULLS FIRST: a null time is the newest
    (2, T(2024, 1, 5), "b", "dated"),
    (None, T(2024, 1, 1), "a", "null-key"),
]
HIST_SCHEMA = "k bigint, ts timestamp_ntz, seq string, v string"


def test_latest_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame(HIST, HIST_SCHEMA)
    out = rows(latest_per_key(df, ["k"], "ts", ["seq"]), "k", "v")
    assert out == sorted([(1, "new-b"), (2, "null-ts"), (None, "null-key")], key=repr)


def test_latest_per_key_equals_row_number_filter(spark):
    rnd = random.Random(7)
    data = [(rnd.randint(0, 20), T(2024, 1, rnd.randint(1, 5)) if rnd.random() > .1 else None,
             str(rnd.randint(0, 3)), str(i)) for i in range(800)]
    df = spark.createDataFrame(data, HIST_SCHEMA)
    w = Window.partitionBy("k").orderBy(*newest_first("ts", ["seq", "v"]))
    ref = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert rows(latest_per_key(df, ["k"], "ts", ["seq", "v"]), *df.columns) == rows(ref, *df.columns)


def test_latest_per_key_per_day(spark):
    df = spark.createDataFrame(
        [(1, T(2024, 1, 1, 9), "a", "x"), (1, T(2024, 1, 1, 17), "a", "y"), (1, T(2024, 1, 2, 1), "a", "z")],
        HIST_SCHEMA,
    )
    out = rows(latest_per_key_per_day(df, ["k"], "ts", "day", ["seq"]), "day", "v")
    assert out == [(D(2024, 1, 1), "y"), (D(2024, 1, 2), "z")]


def test_line_id_join_and_dash_separator(spark):
    from stockroom.plans.items import item_dim
    from stockroom.plans.orders import order_fact, pos_orders
    from stockroom.sources.fixtures import Inputs

    from paths import SF_SMALL

    inp = Inputs(spark, SF_SMALL)
    lines = {(r["id"], r["order_id"]) for r in inp.pos_order_line_history.select("id", "order_id").collect()}
    orders = {r["id"] for r in inp.pos_order_history.select("id").collect()}
    got = pos_orders(inp, line_key="id")  # the line's own id taken for an order id
    assert got.count() == sum(line in orders for line, _ in lines)
    assert pos_orders(inp).count() == sum(order in orders for _, order in lines)
    slash, dash = (sorted(r["uuid"] for r in item_dim(inp, **o).select("uuid").collect()) for o in ({}, {"sep": "-"}))
    assert sorted(u.replace("/", "-") for u in slash) == dash
    assert all("/" not in r[0] for r in order_fact(inp, sep="-").select("itemuuid").collect())


def test_ranks_of_one_key_at_one_hour_and_of_equal_rows(spark):
    rnd = random.Random(13)
    data = [(0, T(2024, 1, 5, 9), f"{rnd.randint(0, 300):03d}", "x") for _ in range(2500)]  # many equal rows
    data += [(rnd.choice([None, 1, 2]), None if rnd.random() < .2 else T(2024, 1, 5, rnd.randint(0, 23)), str(i), "y") for i in range(500)]
    df = spark.createDataFrame(data, HIST_SCHEMA).repartition(5)
    key = ["k", "ts", "seq", "v"]
    for distinct in (False, True):
        given = df.distinct() if distinct else df
        want = given.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*newest_first("ts", ["seq", "v"]))))
        got = rank_versions(df, ["k"], "ts", ["seq", "v"], "rn", distinct=distinct)
        assert rows(got, *key, "rn") == rows(want, *key, "rn")
    assert rank_versions(df.limit(0), ["k"], "ts", ["seq", "v"], "rn").count() == 0
    with pytest.raises(ValueError):
        rank_versions(df, ["k"], "ts", ["seq"], "rn", distinct=True)


def test_asof_carry_equals_range_join(spark):
    """Disjoint intervals of any length, a hot key, keys without intervals, null keys and times."""
    rnd = random.Random(23)
    ivs = []
    for k in [0] * 40 + list(range(1, 25)):
        at = D(1990, 1, 1) + dt.timedelta(days=rnd.randint(0, 300) + (400 * len(ivs) if k == 0 else 0))
        for _ in range(rnd.randint(0, 4)):
            hi = at + dt.timedelta(days=rnd.choice([0, 3, 30, 90]) + (0 if k == 0 else rnd.choice([0, 9000])))
            ivs.append((k, at, hi, len(ivs)))
            at = hi + dt.timedelta(days=rnd.choice([1, 1, 5]))
    ivs += [(None, D(2000, 1, 1), D(2001, 1, 1), -1), (3, None, D(1980, 1, 1), -2), (3, D(1985, 1, 1), D(1984, 1, 1), -3), (4, D(1980, 1, 1), None, -4)]
    points = []
    for i in range(3000):
        k = 0 if i < 1200 else (None if rnd.random() < .05 else rnd.randint(1, 27))
        points.append((k, None if rnd.random() < .03 else D(1990, 1, 1) + dt.timedelta(days=rnd.randint(-50, 25000)), i))
    left = spark.createDataFrame(points, "k int, d date, id int").repartition(4)
    right = spark.createDataFrame(ivs, "rk int, lo date, hi date, rid int").repartition(3)
    for how in ("inner", "left"):
        want = left.join(right, (left["k"] == right["rk"]) & (left["d"] >= right["lo"]) & (left["d"] <= right["hi"]), how)
        got = asof_carry(left, right, [("k", "rk")], "d", "lo", "hi", how)
        assert rows(got, "id", "rid") == rows(want, "id", "rid") and got.columns == want.columns
    again = spark.createDataFrame([(1, D(2024, 1, 1), D(2024, 1, 9), 0), (1, D(2024, 1, 5), D(2024, 1, 6), 1)], right.schema)
    with pytest.raises(Exception, match="overlap"):
        asof_carry(left, again, [("k", "rk")], "d", "lo", "hi").count()


def test_bucketed_ranks_equal_window_ranks_with_a_hot_key(spark):
    rnd = random.Random(11)
    data = []
    for i in range(3000):
        k = 0 if i < 1000 else rnd.randint(1, 50)          # key 0 holds a third of the rows
        ts = None if rnd.random() < .02 else T(2024, 1, rnd.randint(1, 20), rnd.randint(0, 23))
        data.append((k, ts, f"{i:05d}", str(i)))
    df = spark.createDataFrame(data, HIST_SCHEMA)
    a = rows(rank_versions_window(df, ["k"], "ts", ["seq"], "rn"), "v", "rn")
    b = rows(rank_versions(df, ["k"], "ts", ["seq"], "rn"), "v", "rn")
    assert a == b


# ---------------------------------------------------------------- W6
def test_lead_month_equals_global_lead(spark):
    rnd = random.Random(3)
    pairs = {(D(2024, rnd.randint(1, 12), 1) if rnd.random() > .03 else None,
              rnd.randint(1, 60) if rnd.random() > .03 else None) for _ in range(700)}
    df = spark.createDataFrame([(m, k) for m, k in pairs], "m date, k bigint")
    a = rows(lead_month_literal(df, "m", "k", "prev"))
    b = rows(lead_month(df, "m", "k", "prev"))
    assert a == b


# ---------------------------------------------------------------- W5
def test_lead_across_groups_equals_global_lead(spark):
    rnd = random.Random(5)
    data = []
    for i in range(1500):
        g = f"item{rnd.randint(0, 80):03d}" if rnd.random() > .02 else None
        d = D(2024, rnd.randint(1, 3), rnd.randint(1, 28)) if rnd.random() > .02 else None
        data.append((g, d, str(rnd.randint(0, 2)), i))
    df = spark.createDataFrame(data, "g string, d date, loc string, id bigint")
    a = rows(lead_across_groups_literal(df, "g", "d", ["loc", "id"], "prev"))
    b = rows(lead_across_groups(df, "g", "d", ["loc", "id"], "prev"))
    assert a == b


# ---------------------------------------------------------------- J7
def test_spread_over_spine_equals_range_join(spark):
    first, last, _ = spine_bounds(D(2024, 3, 15), years_back=0, years_forward=0)
    spine = date_dim(spark, D(2024, 3, 15), years_back=0, years_forward=0)
    rnd = random.Random(9)
    ivs = []
    for i in range(300):
        lo = D(2023, 12, 1) + dt.timedelta(days=rnd.randint(0, 150))
        hi = lo + dt.timedelta(days=rnd.randint(-3, 40))
        ivs.append((None if rnd.random() < .05 else lo, hi, i))
    iv = spark.createDataFrame(ivs, "lo date, hi date, id bigint")
    cols = ["date", "lo", "hi", "id"]
    a = rows(spine_join_literal(spine, iv, "date", "lo", "hi"), *cols)
    b = rows(spread_over_spine(spine, iv, "date", "lo", "hi", (first, last)), *cols)
    assert a == b


# ---------------------------------------------------------------- calendar
def test_date_dim_range_and_size(spark):
    first, last, n = spine_bounds(D(2001, 12, 31))
    assert (first, last, n) == (D(1998, 1, 2), D(2002, 12, 31), 1825)
    dd = date_dim(spark, D(2001, 12, 31))
    agg = dd.agg(F.min("date"), F.max("date"), F.count("*"), F.countDistinct("date")).first()
    assert tuple(agg) == (first, last, n, n)
    leap = spine_bounds(D(2024, 2, 29))
    assert leap[1] == D(2025, 2, 28)


# ---------------------------------------------------------------- conform
def test_conform_binds_by_position_and_unions_text_ids(spark):
    schema = StructType.fromJson({"type": "struct", "fields": [
        {"name": "locationid", "type": "string", "nullable": True, "metadata": {}},
        {"name": "qty", "type": "long", "nullable": True, "metadata": {}},
    ]})
    a = spark.createDataFrame([(7, 1)], "site_id int, quantity int")
    b = spark.createDataFrame([("x9", 2)], "shop string, q int")
    out = union_conformed(schema, a, b)
    assert out.columns == ["locationid", "qty"]
    assert rows(out) == [("7", 1), ("x9", 2)]
    with pytest.raises(ValueError):
        conform(a.select("site_id"), schema)


def test_required_column_violations(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    empty = df.where("false")
    out = rows(required_column_violations({"t": (df, ["a", "b"]), "e": (empty, ["a"])}))
    assert out == sorted([("t", "a", 1), ("t", "b", 2), ("e", "a", 0)], key=repr)


def test_lead_across_groups_with_duplicates_and_a_hot_group(spark):
    rnd = random.Random(21)
    data = []
    for i in range(2000):
        g = "hot" if i < 700 else (f"g{rnd.randint(0, 40):02d}" if rnd.random() > .02 else None)
        d = D(2024, 1, rnd.randint(1, 5)) if rnd.random() > .03 else None
        data.append((g, d, rnd.choice(["a", "b", None]), rnd.randint(0, 3)))   # many identical rows
    df = spark.createDataFrame(data, "g string, d date, loc string, q int")
    a = rows(lead_across_groups_literal(df, "g", "d", ["loc", "q"], "prev"))
    b = rows(lead_across_groups(df, "g", "d", ["loc", "q"], "prev"))
    assert a == b


def test_leads_per_key(spark):
    rnd = random.Random(31)
    data = []
    for i in range(1200):
        g = "hot" if i < 400 else (f"g{rnd.randint(0, 30)}" if rnd.random() > .03 else None)
        data.append((g, D(2024, rnd.randint(1, 4), rnd.randint(1, 28)) if rnd.random() > .03 else None, i))
    df = spark.createDataFrame(data, "g string, d date, id int")
    w = Window.partitionBy("g").orderBy(F.col("d").desc_nulls_first(), F.col("id").asc_nulls_last())
    assert rows(lead_across_groups(df, "g", "d", ["id"], "prev", "per_key")) == rows(df.withColumn("prev", F.lead("d").over(w)))
    months = df.select(F.last_day("d").alias("m"), F.col("g").alias("k")).distinct()
    w = Window.partitionBy("k").orderBy(F.col("m").desc_nulls_first())
    got = lead_month(months, "m", "k", "prev", boundary="per_key")
    assert rows(got) == rows(months.withColumn("prev", F.lead("m").over(w)))


def test_intervals_per_item_and_location(spark):
    from stockroom.plans.inventory import cost_intervals
    from stockroom.plans.marts import inventory_intervals
    from stockroom.plans.registry import Mart

    from paths import SF_SMALL

    m = Mart(spark, SF_SMALL)
    fact = m.inventory_fact_table
    got = inventory_intervals(fact, "per_key")
    w = Window.partitionBy("itemuuid", "locationid").orderBy(F.col("date").desc_nulls_first())
    want = fact.withColumn("p", F.lead("date").over(w)).groupBy("itemuuid", "locationid", "date", "p").count()
    # several rows of one day differ in their tie columns only, so the multiset of leads is what is fixed
    have = got.groupBy("itemuuid", "locationid", "date", F.col("previousrecorddate").alias("p")).count()
    assert rows(have) == rows(want)
    costs = cost_intervals(m.inp, boundary="per_key")
    assert costs.where("previousmonthending >= monthending").count() == 0


def test_lead_over_few_rows_and_more_ranges(spark):
    for n in (0, 1, 3):
        df = spark.createDataFrame([(f"g{i}", D(2024, 1, 1 + i)) for i in range(n)], "g string, d date")
        assert rows(lead_across_groups(df, "g", "d", [], "prev")) == rows(lead_across_groups_literal(df, "g", "d", [], "prev"))


def test_asof_join_by_month_equals_range_join(spark):
    rnd = random.Random(17)
    day = lambda: D(2023, 11, 1) + dt.timedelta(days=rnd.randint(0, 200))
    left = spark.createDataFrame([(rnd.randint(0, 9), None if rnd.random() < .05 else day(), i) for i in range(400)],
                                 "k int, d date, id int")
    ivs = []
    for i in range(200):
        lo = day()
        ivs.append((rnd.randint(0, 9), None if rnd.random() < .05 else lo, lo + dt.timedelta(days=rnd.randint(-5, 90)), i))
    right = spark.createDataFrame(ivs, "rk int, lo date, hi date, rid int")
    a = rows(asof_join_literal(left, right, [("k", "rk")], "d", "lo", "hi"), "id", "rid")
    assert a == rows(asof_join(left, right, [("k", "rk")], "d", "lo", "hi"), "id", "rid")


def test_sales_aggregated_before_the_item_join(spark):
    from stockroom.plans.marts import discounted_sales_by_item, sales_weekly

    rnd = random.Random(23)
    spine = date_dim(spark, D(2024, 3, 15), years_back=0, years_forward=0)
    orders = []
    for i in range(1200):
        item = "hot" if i < 400 else rnd.choice([f"item{rnd.randint(0, 15)}", None])
        orders.append((D(2024, 1, 1) + dt.timedelta(days=rnd.randint(-3, 70)), item, str(rnd.randint(0, 300)), rnd.randint(1, 9),
                       Decimal(rnd.randint(1, 9999)) / 100, Decimal(rnd.randint(0, 30)), rnd.choice(["1", "2", None]),
                       rnd.choice(["pos", "shop"])))
    orders = spark.createDataFrame(orders, "date date, itemuuid string, orderuuid string, qty_sold bigint, "
                                           "price decimal(10,2), discount decimal(38,0), locationid string, source string")
    items = []
    for u in ["hot", "hot", "hot", *[f"item{i % 12}" for i in range(30)]]:  # repeated and differing rows of one uuid
        items.append(("s", u, rnd.choice(["b1", "b2"]), None, "c", "d", "red", "L", "x", rnd.choice(["pos", "shop"])))
    items = spark.createDataFrame(items, "sku string, uuid string, brandname string, vendorid string, categoryid string, "
                                         "description string, color string, size string, attribute3 string, source string")
    weekly, by_item = sales_weekly_by_row(spine, orders, items)
    got = sales_weekly(spine, orders, items)
    assert rows(got) == rows(weekly.select(*got.columns))
    got = discounted_sales_by_item(spine, orders, items)
    assert rows(got) == rows(by_item.select(*got.columns))


def test_weekly_pieces_equal_day_level_weekly(spark):
    from stockroom.plans.marts import inventory_weekly

    as_of = D(2024, 3, 15)
    first, last, _ = spine_bounds(as_of, years_back=0, years_forward=0)
    spine = date_dim(spark, as_of, years_back=0, years_forward=0)
    rnd = random.Random(13)
    ivs = []
    for i in range(400):
        hi = D(2023, 12, 20) + dt.timedelta(days=rnd.randint(0, 120))
        lo = None if rnd.random() < .05 else hi - dt.timedelta(days=rnd.randint(0, 30))
        qoh = None if rnd.random() < .1 else rnd.randint(0, 50)
        cost = None if rnd.random() < .1 else Decimal(rnd.randint(100, 99999)) / 100
        ivs.append((hi, f"sku{i % 7}", f"item{rnd.randint(0, 12)}", qoh, rnd.randint(0, 3), cost,
                    rnd.choice(["1", "2", None]), "cat", "pos", None, lo))
    schema = ("date date, sku string, itemuuid string, qoh bigint, backorder bigint, cost decimal(6,2), "
              "locationid string, categoryid string, source string, previousrecorddate date, startrecorddate date")
    iv = spark.createDataFrame(ivs, schema)
    items = spark.createDataFrame(
        [(f"item{i}", f"b{i % 3}", "d", "c", "s", "a") for i in range(0, 12, 2)],
        "uuid string, brandname string, description string, color string, size string, attribute3 string")
    locs = spark.createDataFrame([("1", "north"), ("2", "south")], "locationid string, category string")
    a = rows(inventory_weekly_by_day(spine, iv, items, locs))
    b = rows(inventory_weekly(spine, iv, items, locs, (first, last)))
    assert a == b


def _long_intervals_in_one_file(spark):
    """400 intervals of a year in one partition, beside as many of a day."""
    day = "date_add(date'2001-01-01', cast(id % 7 AS int))"
    rows = spark.range(800, numPartitions=1).selectExpr(
        f"{day} AS lo", f"CASE WHEN id < 400 THEN date_add({day}, 364) ELSE {day} END AS hi", "concat('i', id) AS item"
    )
    days = spark.sql("SELECT explode(sequence(date'2001-01-01', date'2002-06-30')) AS date")
    return rows, days, (dt.date(2001, 1, 1), dt.date(2002, 6, 30))


def test_long_intervals_side_by_side_are_expanded_by_many_tasks(spark):
    from stockroom.operators.intervals import spread_over_spine

    rows, days, bounds = _long_intervals_in_one_file(spark)
    got = spread_over_spine(days, rows, "date", "lo", "hi", bounds).where("item IS NOT NULL")
    tasks = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 400 * 365 + 400 and max(tasks) < sum(tasks) / 4


def test_weekly_rows_are_made_by_many_tasks_and_grouped_there(spark):
    from stockroom.functions import week_ending
    from stockroom.operators.intervals import spread_over_weeks

    rows, days, bounds = _long_intervals_in_one_file(spark)
    keys = [F.year("date").alias("year"), week_ending("date").alias("weekending")]
    got = spread_over_weeks(days, rows, "date", "lo", "hi", bounds, keys, by=["item"]).where("item IS NOT NULL")
    tasks = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert got.agg(F.sum("_days")).first()[0] == 400 * 365 + 400 and max(tasks) < sum(tasks) / 3
    plan = got.groupBy("item", "year", "weekending").agg(F.sum("_days"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan.split("Generate explode")[0]
