"""Writers for the conformed tables and the daily snapshot history."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stockroom.operators.conform import conform
from stockroom.session import ensure_checkpoint_dir

# Versions of a replaced table that stay: the newest, and the one before for its readers.
KEPT_VERSIONS = 2
_VERSION = "__version_"


def checked(df: DataFrame, table: str, required: Sequence[str] = (), longest: Mapping[str, int] | None = None) -> DataFrame:
    """``df`` whose evaluation fails on a null in a required column or a text longer than declared."""
    out = df
    for c in required:
        said = F.raise_error(F.lit(f"{table}.{c} must not be null"))
        out = out.withColumn(c, F.when(F.col(c).isNull(), said.cast(df.schema[c].dataType)).otherwise(F.col(c)))
    for c, n in (longest or {}).items():
        said = F.raise_error(F.concat(F.lit(f"{table}.{c} takes {n} characters: "), F.col(c)))
        out = out.withColumn(c, F.when(F.length(c) > n, said).otherwise(F.col(c)))
    return out


def replace_table(
    df: DataFrame, table: str, location: str, schema: StructType | None = None, required: Sequence[str] = (),
    longest: Mapping[str, int] | None = None, observed: Sequence[str] = (), properties: Mapping[str, str] | None = None,
    keep: int = KEPT_VERSIONS,
) -> None:
    """``CREATE OR REPLACE TABLE t(cols) AS SELECT``: bind to the declared schema by
    position, cast, check, write a new version under ``location`` and publish it.

    A version is a catalog table of its own name; ``table`` is a catalog view that
    selects the newest one.  Publishing replaces that view in one catalog step, so
    every session reads the old version or the new one, whatever the columns of
    either, and a failed check or write leaves the table as it was.  The ``keep`` newest
    versions stay for readers that have planned on them; older ones are removed.
    The nulls of ``observed`` columns and the rows are counted by the write itself
    and kept, like ``properties``, with the view (``table_properties``).
    """
    spark = df.sparkSession
    out = checked(conform(df, schema) if schema is not None else df, table, required, longest)
    seen = Observation()
    counts = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"nulls.{c}") for c in observed]
    # names sort by age
    number = f"{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    version, path = f"{table}{_VERSION}{number}", f"{location.rstrip('/')}/version-{number}"
    out.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.parquet(path)
    spark.catalog.createTable(version, path=path, source="parquet", schema=out.schema)
    kept = {**(properties or {}), "version": version, **{k: str(v) for k, v in seen.get.items()}}
    said = ", ".join(f"'{k}' = '{v}'" for k, v in kept.items())
    columns = ", ".join(f"`{c}`" for c in out.columns)
    if _is_plain_table(spark, table):
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({said}) AS SELECT {columns} FROM {version}")
    _drop_versions(spark, table, keep)


def _is_plain_table(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType not in ("VIEW", "TEMPORARY")


def _drop_versions(spark: SparkSession, table: str, keep: int) -> None:
    """Remove all but the newest versions of a table, files included."""
    database, name = table.rsplit(".", 1) if "." in table else (spark.catalog.currentDatabase(), table)
    found = spark.sql(f"SHOW TABLES IN {database} LIKE '{name}{_VERSION}*'").collect()
    for old in sorted(r["tableName"] for r in found)[:-keep]:
        described = spark.sql(f"DESCRIBE EXTENDED {database}.{old}").filter("col_name = 'Location'").first()
        spark.sql(f"DROP TABLE {database}.{old}")
        path = spark._jvm.org.apache.hadoop.fs.Path(described["data_type"])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table_properties(spark: SparkSession, table: str) -> dict[str, str]:
    """What ``replace_table`` kept beside a table: rows, ``nulls.<column>``, version and the caller's."""
    if not spark.catalog.tableExists(table):
        return {}
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def append_snapshot(
    df: DataFrame, path: str, schema: StructType | None = None, partition_col: str | Sequence[str] = "insertdate",
    dealt: bool = False,
) -> None:
    """``INSERT INTO history SELECT`` for one or more run days.  The history is
    partitioned by run day and written with dynamic partition overwrite, so a
    rerun of a day replaces that day instead of appending it twice, and other
    days are untouched.  ``dealt`` rows lie by their partition already."""
    partitions = [partition_col] if isinstance(partition_col, str) else list(partition_col)
    out = conform(df, schema) if schema is not None else df
    if not dealt:
        # a partition comes from as few tasks as its size allows, so it has few files
        out = out.hint("rebalance", *[F.col(c) for c in partitions])
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        .partitionBy(*partitions).parquet(path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder (``spark.checkpoint.dir``)
    and read it back: cuts the lineage, so a lost executor recomputes from the
    written files rather than from the sources."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove the files of a table of ``materialize`` that nothing reads any more."""
    spark = table.sparkSession
    for place in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
