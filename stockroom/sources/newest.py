"""A stored newest-row table of a change log, advanced by its new changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.operators.dedup import latest_per_key
from stockroom.sources.sinks import replace_table


class NewestTable:
    """The newest row of each key of an append-only change log, kept as a catalog table.

    The log may be read in any number of steps: each ``advance`` joins the stored
    rows with the log's rows from the high-water mark on (the greatest stored
    time; rows at that time may still have come in, rows without a time are the
    newest of their key and always read), and publishes a new version.  The
    result is that of ``latest_per_key`` over all rows read so far, so reading rows
    twice does no harm.
    """

    def __init__(
        self, spark: SparkSession, table: str, location: str, keys: Sequence[str], ts: str, tie_breakers: Sequence[str],
        columns: Sequence[str],
    ):
        self.spark, self.name, self.location = spark, table, location
        self.keys, self.ts, self.ties = list(keys), ts, list(tie_breakers)
        self.columns = list(columns)
        # what decides between two rows is kept beside the columns
        self.stored = list(dict.fromkeys([*self.keys, self.ts, *self.ties, *self.columns]))

    def high_water_mark(self):
        """The greatest time in the table, or None."""
        if not self.spark.catalog.tableExists(self.name):
            return None
        return self.spark.table(self.name).agg(F.max(self.ts)).first()[0]

    def new_changes(self, log: DataFrame) -> DataFrame:
        """The rows of the log that an advance reads: the bound is a filter on the time, for the scan to prune by."""
        mark = self.high_water_mark()
        if mark is None:
            return log
        t = F.col(self.ts)
        return log.where(t.isNull() | (t >= F.lit(mark).cast(log.schema[self.ts].dataType)))

    def advance(self, log: DataFrame) -> DataFrame:
        """Take in the new rows of ``log``; returns the newest row of each key."""
        if "." in self.name:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.name.rsplit('.', 1)[0]}")
        rows = self.new_changes(log).select(*self.stored)
        if self.spark.catalog.tableExists(self.name):
            rows = self.spark.table(self.name).unionByName(rows)
        replace_table(latest_per_key(rows, self.keys, self.ts, self.ties, self.stored).select(*self.stored), self.name, self.location)
        return self.table()

    def table(self) -> DataFrame:
        return self.spark.table(self.name).select(*self.keys, *[c for c in self.columns if c not in self.keys])
