"""The mart as catalog tables and views, in the source's build order.

1. calendar and the run days' stock snapshots (appended to their history);
2. item and location dimensions, order fact, inventory fact (which reads the
   snapshot history);
3. the weekly views, catalog views over those tables (``views``).

``MartTables`` keeps such tables per data folder and builds one only when the
files that it is made from, or the run parameters, have changed.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.plans import calendar, inventory, items, locations, orders
from stockroom.plans.schemas import DATE_DIM, INVENTORY_FACT, ITEM_DIM, LOCATION_DIM, ORDER_FACT, REQUIRED, longest
from stockroom.plans.views import VIEW_TABLES, create_views
from stockroom.session import ensure_checkpoint_dir
from stockroom.sources.fixtures import DRIVER_TABLES, SOURCES, Inputs
from stockroom.sources.sinks import replace_table, table_properties

# Columns whose nulls are counted while a table is written, and those for which
# a null is refused.  The source's web-shop branch has no location names although
# the column is declared NOT NULL: those rows are kept and counted.
OBSERVED = REQUIRED
REFUSED = {**REQUIRED, "location_dim": []}
SCHEMAS = {
    "date_dim": DATE_DIM, "item_dim": ITEM_DIM, "location_dim": LOCATION_DIM, "order_fact": ORDER_FACT,
    "inventory_fact": INVENTORY_FACT,
}
# Driver tables that the mart's inputs are projections of.
MART_INPUTS = tuple(t for t in DRIVER_TABLES if t not in {"documents", "embeddings", "benchmark", "labels", "conversations"})


def build_mart(
    spark: SparkSession,
    sf_dir: str,
    out_dir: str,
    run_days: Sequence[dt.date],
    min_order_date: dt.date = orders.MIN_ORDER_DATE,
    staged_dir: str | None = None,
    database: str = "stockroom",
) -> dict[str, str]:
    """Write the dimensions and facts of the last of ``run_days`` under ``out_dir``
    as tables of ``database``; return their full names."""
    out = out_dir.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    inp = Inputs(spark, sf_dir, staged_dir)
    names: dict[str, str] = {}

    def put(name: str, df: DataFrame) -> None:
        names[name] = f"{database}.{name}"
        put_table(df, name, names[name], f"{out}/{name}")

    put("date_dim", calendar.date_dim(spark, run_days[-1]))
    history = inventory.stock_snapshot_history(inp, run_days, f"{out}/stock_snapshot_history")
    put("item_dim", items.item_dim(inp))
    put("location_dim", locations.location_dim(inp))
    put("order_fact", orders.order_fact(inp, min_order_date))
    put("inventory_fact", inventory.inventory_fact(inp, history))
    create_views(spark, database)
    return names


def put_table(df: DataFrame, name: str, full_name: str, location: str, **properties: str) -> None:
    """Replace one mart table, with its declared schema and rules."""
    schema = SCHEMAS[name]
    replace_table(
        df, full_name, location, schema, REFUSED.get(name, ()), longest(name, schema), OBSERVED.get(name, ()), properties
    )


def inputs_version(spark: SparkSession, paths: Sequence[str]) -> str:
    """A digest of the names, sizes and times of the files of some tables (their content is not read)."""
    files = spark.read.format("binaryFile").load(list(paths))
    listed = files.select(F.xxhash64("path", "length", "modificationTime").alias("h"))
    found = listed.agg(F.count("h").alias("n"), F.expr("sum(cast(h as decimal(38,0)))").alias("total")).first()
    return f"{found['n']}:{found['total']}"


class MartTables:
    """The mart tables of one data folder, each built when it is first asked for
    and again only when its inputs or parameters change.

    ``builders`` maps a table name to a function that gives its rows; ``parameters``
    is what those depend on beside the files.  The tables live in a database of
    their own, named after the folder and the place they are written to.
    """

    def __init__(
        self, spark: SparkSession, folder: str, builders: Mapping[str, Callable[[], DataFrame]], parameters: str = "",
        staged_dir: str | None = None,
    ):
        self.spark, self.builders = spark, builders
        self.folder, self.staged_dir, self.parameters = folder, staged_dir, parameters
        base = ensure_checkpoint_dir(spark).rstrip("/")
        name = hashlib.sha256("|".join([folder.rstrip("/"), staged_dir or "", base]).encode()).hexdigest()[:16]
        self.database, self.location = f"stockroom_mart_{name}", f"{base}/mart-{name}"
        self._version: str | None = None

    @property
    def version(self) -> str:
        if self._version is None:
            staged = [f"{self.staged_dir.rstrip('/')}/{name}" for name in SOURCES] if self.staged_dir else None
            given = [f"{self.folder.rstrip('/')}/{t}.parquet" for t in MART_INPUTS]
            files = inputs_version(self.spark, staged or given)
            self._version = f"{files}|{self.parameters}"
        return self._version

    def name(self, table: str) -> str:
        """Full name of an up-to-date table."""
        full = f"{self.database}.{table}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        if table_properties(self.spark, full).get("inputs") != self.version:
            put_table(self.builders[table](), table, full, f"{self.location}/{table}", inputs=self.version)
        return full

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def views(self) -> dict[str, str]:
        """The weekly views over up-to-date tables."""
        for table in SCHEMAS:
            self.name(table)
        return create_views(self.spark, self.database)

    def view(self, view: str) -> DataFrame:
        """One weekly view, over those up-to-date tables that it reads."""
        for table in VIEW_TABLES[view]:
            self.name(table)
        return self.spark.table(create_views(self.spark, self.database, [view])[view])


def stored_violations(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """Null count of every ``NOT NULL`` column as counted while the tables were
    written: ``table_name, column_name, null_count`` for name -> full name."""
    rows = []
    for name, full in tables.items():
        kept = table_properties(spark, full)
        rows += [(name, c, int(kept[f"nulls.{c}"])) for c in OBSERVED[name]]
    return spark.createDataFrame(rows, "table_name string, column_name string, null_count bigint")
