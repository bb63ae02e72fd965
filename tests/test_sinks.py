"""Table writers: replace by position, dated snapshot rerun, lineage cut."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockroom.plans.schemas import LOCATION_DIM, STOCK_SNAPSHOT
from stockroom.sources.sinks import append_snapshot, materialize, read_table, replace_table


def _snap(spark, day, n):
    rows = [(f"{day}/1/{i}", day, str(day), f"sku{i}", str(i), i, 0, None, "1", "2") for i in range(n)]
    return spark.createDataFrame(rows, STOCK_SNAPSHOT)


def test_replace_table_binds_by_position_and_swaps_versions(spark, tmp_dir):
    df = spark.createDataFrame([(5, "Main", "UTC", "pos")], "id int, name string, tz string, src string")
    replace_table(df, "loc_test", f"{tmp_dir}/loc", LOCATION_DIM)
    out = spark.table("loc_test")
    assert out.columns == [f.name for f in LOCATION_DIM.fields]
    assert out.first()["locationid"] == "5"
    replace_table(df.withColumn("id", F.lit(6)), "loc_test", f"{tmp_dir}/loc", LOCATION_DIM)
    assert [r["locationid"] for r in spark.table("loc_test").collect()] == ["6"]
    replace_table(df.select("id"), "loc_test", f"{tmp_dir}/loc")  # another layout
    assert spark.table("loc_test").columns == ["id"]


def test_replace_table_checks_declared_rules_and_keeps_the_old_version(spark, tmp_dir):
    good = spark.createDataFrame([("1", "Main", "UTC", "pos")], LOCATION_DIM)
    write = lambda df: replace_table(df, "loc_rules", f"{tmp_dir}/loc2", LOCATION_DIM, ["locationname"], {"category": 5})
    write(good)
    for bad, said in ((good.withColumn("locationname", F.lit(None).cast("string")), "must not be null"),
                      (good.withColumn("category", F.lit("too long")), "takes 5 characters")):
        with pytest.raises(Exception, match=said):
            write(bad)
    assert [tuple(r) for r in spark.table("loc_rules").collect()] == [("1", "Main", "UTC", "pos")]


def test_old_versions_are_removed_and_readers_keep_theirs(spark, tmp_dir):
    import os

    where = f"{tmp_dir}/kept"
    frames = []
    for i in range(4):
        replace_table(spark.range(i + 1).withColumn(f"c{i}", F.lit(i)), "kept_versions", where)
        frames.append(spark.table("kept_versions"))
    assert len([d for d in os.listdir(where) if d.startswith("version-")]) == 2
    assert frames[-1].count() == 4 and frames[-2].count() == 3  # a plan on the version before still reads it
    assert [r["tableName"] for r in spark.sql("SHOW TABLES LIKE 'kept_versions*'").collect() if "__version_" not in r["tableName"]] == ["kept_versions"]


def test_cluster_needs_a_shared_checkpoint_folder():
    from types import SimpleNamespace

    from stockroom.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda *_: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077")))


def test_snapshot_rerun_replaces_only_its_day(spark, tmp_dir):
    path = f"{tmp_dir}/history"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    append_snapshot(_snap(spark, d1, 3), path)
    append_snapshot(_snap(spark, d2, 2), path)
    append_snapshot(_snap(spark, d2, 4), path)  # rerun of day 2
    counts = dict(read_table(spark, path).groupBy("insertdate").count().collect())
    assert counts == {d1: 3, d2: 4}


def test_materialize_cuts_lineage(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    m = materialize(df, "unit")
    assert m.agg(F.sum("x")).first()[0] == 9900
    assert "FileScan parquet" in m._jdf.queryExecution().executedPlan().toString()
