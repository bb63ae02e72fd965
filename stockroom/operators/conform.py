"""Target-table conformance: positional binding, casts, unions, not-null rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Bind the columns of ``df`` to ``schema`` by position and cast each one
    (``CREATE TABLE t(cols) AS SELECT`` / ``INSERT INTO t(cols) SELECT``)."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} columns for a {len(schema.fields)}-column target")
    renamed = df.toDF(*[f.name for f in schema.fields])
    return renamed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def union_conformed(schema: StructType, *branches: DataFrame) -> DataFrame:
    """``UNION ALL`` of branches, each first bound and cast to the target schema
    (so e.g. a numeric id and a text id meet as text, not as bigint)."""
    return reduce(DataFrame.unionAll, [conform(b, schema) for b in branches])


def required_column_violations(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Null count of every ``NOT NULL`` column: one aggregate pass per table.

    Output: ``table_name, column_name, null_count``.
    """
    parts = []
    for table, (df, cols) in tables.items():
        counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
        stacked = counts.select(
            F.lit(table).alias("table_name"),
            F.explode(F.array(*[
                F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in cols
            ])).alias("_v"),
        )
        parts.append(stacked.select("table_name", "_v.column_name", "_v.null_count"))
    return reduce(DataFrame.unionAll, parts)
