"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.session import ensure_checkpoint_dir

# The six ASCII blanks that separate words in every contract here (a fixed value).
BLANKS = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use, whatever extra columns it carries."""
    taken = {c.lower() for c in df.columns}
    name, k = f"__{base}", 0
    while name.lower() in taken:
        k += 1
        name = f"__{base}_{k}"
    return name


def col(name: str) -> Column:
    """The column of exactly this name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with files that every executor sees, so a lost executor
    re-reads a table and two readers of a result never see two evaluations.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
