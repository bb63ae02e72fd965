"""A training-data pipeline over ``documents``: the stages and how to run them.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept
and returns a DataFrame; ``run`` writes each result as Parquet under
``spark.checkpoint.dir`` and hands the reread table to the next stage.  All but
the last return the columns of ``documents``; a stage that changes a text also
sets ``n_chars``.  SQL cannot express the stages, so ``ORACLE_SQL`` is None and
``tests/llm/test_pipeline.py`` compares them with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.llm import lines, packing, quality, secrets, simhash
from stockroom.llm.common import documents, materialize

ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.filter_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in three or more documents stay in the largest doc_id only."""
    return _counted(lines.dedup_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.dedup(docs, words=simhash.SHINGLE_WORDS, max_bits=simhash.MAX_BITS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text."""
    return _counted(secrets.redact_documents(docs))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece of a document."""
    # workers are shared with the stages before, so a smaller memory of words
    return packing.pack_documents(docs, memory_words=300_000)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", secret_scan),
    ("packing", pack_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = documents(spark, sf_dir)
    for name, stage in STAGES:
        out = materialize(stage(spark, out, sf_dir), "stage-" + name.replace(" ", "-"))
    return out
