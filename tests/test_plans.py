"""Physical-plan shape: what the plans must (not) contain to scale."""

import re

import pytest

import __spark_entry__ as entry_mod
from stockroom.operators.dedup import latest_per_key
from stockroom.operators.intervals import spread_over_spine
from stockroom.plans.calendar import date_dim, spine_bounds
from stockroom.plans.registry import QUERIES
from stockroom.sources.fixtures import Inputs

from literal_forms import spine_join_literal

from paths import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_nested_loop_or_cartesian_join(spark, key):
    p = plan(entry_mod.queries()[key](spark, SF_SMALL))
    assert not re.search(r"NestedLoopJoin|CartesianProduct", p), key


def test_latest_per_key_reduces_before_the_shuffle(spark):
    inp = Inputs(spark, SF_SMALL)
    p = plan(latest_per_key(inp.pos_order_history, ["id"], "updated_time", ["change_seq", "change_line", "change_part", "change_sub"]))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_literal_spine_join_is_nested_loop_and_spread_is_not(spark):
    import datetime as dt

    spine = date_dim(spark, dt.date(2024, 3, 1), years_back=0)
    iv = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 9))], "lo date, hi date")
    assert "NestedLoopJoin" in plan(spine_join_literal(spine, iv, "date", "lo", "hi"))
    p = plan(spread_over_spine(spine, iv, "date", "lo", "hi", spine_bounds(dt.date(2024, 3, 1), years_back=0)[:2]))
    assert "NestedLoopJoin" not in p and "BroadcastHashJoin" in p


def test_order_date_filter_reaches_the_scan(spark):
    p = plan(entry_mod.queries()["shop_orders"](spark, SF_SMALL))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", p)
    assert any("o_orderdate" in f for f in pushed), pushed


def test_scan_reads_only_used_columns(spark):
    p = plan(entry_mod.queries()["monthly_avg_cost"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    cols = {c.split(":")[0] for s in schemas for c in s.split(",")}
    assert cols == {"l_partkey", "l_shipdate", "l_extendedprice", "l_quantity"}, cols


def test_sales_view_broadcasts_the_calendar(spark):
    p = plan(entry_mod.queries()["sales_weekly"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p


@pytest.fixture()
def large_tables(spark):
    """Plans as for large tables: no join side is small enough to broadcast by size."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def _nodes(p: str) -> list[tuple[int, str]]:
    """(depth, text) of the lines of a plan tree."""
    return [(len(m[1]), m[2]) for m in re.finditer(r"^([ :+|*()\d-]*)([A-Za-z].*)$", p, re.M)]


@pytest.mark.parametrize("key", sorted(set(QUERIES) - {"option_info"}))
def test_no_single_task_above_a_fact(spark, large_tables, key):
    """What is ordered in one task is a code list, the months or the spine: an
    aggregate, the generated calendar or a join with it, never rows of a history."""
    nodes = [(d, t) for d, t in _nodes(plan(QUERIES[key](spark, SF_SMALL))) if not re.match("InputAdapter|Project|Filter|Sort ", t)]
    for (_, text), (_, below) in zip(nodes, nodes[1:], strict=False):
        if text.startswith("Exchange SinglePartition"):
            assert re.match("(Hash|Sort|ObjectHash)Aggregate|Generate|Range|SortMergeJoin|LocalTableScan|Window|TakeOrdered|GlobalLimit|LocalLimit", below), below


def test_months_are_aggregated_before_any_exchange_on_the_month(spark, large_tables):
    p = plan(QUERIES["cost_intervals"](spark, SF_SMALL))
    for m in re.finditer(r"Exchange hashpartitioning\((_m#\d+|monthending#\d+),", p):
        below = p[m.end():].split("\n")[1]
        assert "partial_min" in below, below


def test_sales_shrink_before_the_item_join(spark, large_tables):
    for key in ("sales_weekly", "discounted_sales_by_item"):
        p = plan(QUERIES[key](spark, SF_SMALL))
        join = p.index("SortMergeJoin") if "SortMergeJoin" in p else p.index("ShuffledHashJoin")
        assert "HashAggregate" in p[join:join + 3000] and "itemuuid" in p[join:join + 300]


def test_weekly_inventory_joins_each_dimension_once(spark, large_tables):
    p = plan(QUERIES["inventory_weekly"](spark, SF_SMALL))
    assert len(re.findall(r"(?:SortMergeJoin|ShuffledHashJoin) \[itemuuid#\d+\]", p)) == 1
    assert len(re.findall(r"(?:SortMergeJoin|ShuffledHashJoin) \[_lkey#\d+", p)) == 1


@pytest.fixture()
def written(monkeypatch):
    """The frames that the ordered scans write, unexecuted plans included, by name."""
    from stockroom.operators import ordered

    frames, write = [], ordered.materialize

    def spy(df, name):
        frames.append((name, plan(df)))
        return write(df, name)

    monkeypatch.setattr(ordered, "materialize", spy)
    return frames


def _exchanges(p: str) -> list[str]:
    return re.findall(r"(?:Broadcast)?Exchange \w+", p)


def test_interval_lead_shuffles_the_fact_once(spark, large_tables, written):
    from stockroom.plans.marts import inventory_intervals
    from stockroom.plans.registry import Mart

    led = inventory_intervals(Mart(spark, SF_SMALL).inventory_fact_table)
    (name, p), = written
    assert name == "interval-order" and _exchanges(p) == ["Exchange rangepartitioning"]
    # after that only one row a range moves: the ends of the ranges, and they are broadcast
    p = plan(led)
    for m in re.finditer(r"Exchange (hashpartitioning|SinglePartition)[^\n]*\n([^\n]*)", p):
        assert re.search(r"Aggregate|Sort ", m[2]), m[0]
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" in p


def test_version_ranks_shuffle_the_wide_rows_once(spark, large_tables, written, tmp_dir):
    from stockroom.plans.registry import build
    from stockroom.sources.fixtures import stage_inputs

    stage_inputs(spark, SF_SMALL, f"{tmp_dir}/staged", 2)
    for key in ("category_levels_ranked", "discounted_orders_ranked", "channel_inventory"):
        written.clear()
        p = plan(build(key, spark, SF_SMALL, f"{tmp_dir}/staged"))
        (name, scan), = written
        # distinct and rank in one pass; what follows reads the written table
        assert name == "version-order" and _exchanges(scan) == ["Exchange rangepartitioning"]
        assert "Window" not in scan and "Aggregate" not in scan
        assert not re.search("staged/pos_(category|order|item_shop)_history", p) or key == "channel_inventory"
        assert "staged/pos_item_shop_history" not in p


def test_carried_asof_join_shuffles_points_and_intervals_once(spark, large_tables, written):
    from stockroom.operators.intervals import asof_carry

    left = spark.range(100).selectExpr("id % 7 AS k", "date_add(DATE'2024-01-01', cast(id AS int)) AS d")
    right = spark.range(7).selectExpr("id AS rk", "DATE'1900-01-01' AS lo", "DATE'2100-01-01' AS hi")
    out = asof_carry(left, right, [("k", "rk")], "d", "lo", "hi")
    (_, p), = written
    assert _exchanges(p) == ["Exchange rangepartitioning"] and "Generate" not in p
    assert out.count() == 100 and "SortMergeJoin" not in plan(out)


def test_keys_over_the_built_fact_do_not_plan_the_snapshots(spark, large_tables):
    QUERIES["inventory_intervals"](spark, SF_SMALL)
    for key in ("inventory_intervals", "inventory_on_spine", "required_column_violations"):
        p = plan(QUERIES[key](spark, SF_SMALL))
        assert "lineitem" not in p and "events" not in p, key
    p = plan(QUERIES["inventory_weekly_view"](spark, SF_SMALL))
    assert "lineitem" not in p and "events" not in p


def test_weekly_view_looks_up_ranges_of_items_and_groups_where_it_expands(spark, large_tables):
    p = plan(QUERIES["inventory_weekly_view"](spark, SF_SMALL))
    # no range is looked up for a record of the fact, below the first aggregate of its items
    for line in p.split("\n"):
        if re.match(r"[ :+|*()\d-]*Filter", line):
            assert "lambda" not in line, line
    nodes = [t for _, t in _nodes(p)]
    above = nodes[:next(i for i, t in enumerate(nodes) if t.startswith("Generate explode"))]
    assert not [t for t in above if t.startswith("Exchange hashpartitioning")]


def test_weekly_sales_meet_once_for_sums_and_orders(spark, large_tables):
    for key in ("sales_weekly", "sales_weekly_view", "sales_weekly_from_state"):
        p = plan(QUERIES[key](spark, SF_SMALL))
        dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
        assert not [e for e in dealt if "orderuuid" in e and "itemuuid" in e], (key, dealt)
        assert len([e for e in dealt if "locationid" in e]) == 1, (key, dealt)
