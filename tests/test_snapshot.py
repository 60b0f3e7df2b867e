"""Published tables: whole states, folders that go and stay, writes that die."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabularium import sources as src

KEYS = ["UF", "MUNICIPIO"]


@pytest.fixture
def places(spark):
    rows = [(1, "PR", "007"), (2, "PR", "A/B+c d"), (3, "SP", "007"), (4, None, "-"), (5, "SP", "é=1")]
    return spark.createDataFrame(rows, "v int, UF string, MUNICIPIO string")


def bag(df):
    return Counter(tuple(r) for r in df.select("v", *KEYS).collect())


def test_a_smaller_delivery_leaves_no_stale_city(spark, places, tmp_path):
    path = str(tmp_path / "t")
    assert src.publish(places, path, KEYS) == 1
    back = src.read_snapshot(spark, path)
    assert back.columns == ["v", *KEYS] and back.schema == places.schema and bag(back) == bag(places)
    assert src.publish(places.where("UF = 'PR'"), path, KEYS) == 2
    assert bag(src.read_snapshot(spark, path)) == bag(places.where("UF = 'PR'"))
    assert bag(src.read_snapshot(spark, path, version=1)) == bag(places)
    src.publish(places.limit(0), path, KEYS)
    assert src.read_snapshot(spark, path).count() == 0 and src.read_snapshot(spark, path).schema == places.schema


def test_kept_folders(spark, places, tmp_path):
    path = str(tmp_path / "t")
    src.publish(places, path, KEYS)
    src.publish(places.where("v in (2, 4)").withColumn("v", F.col("v") * 10), path, KEYS, "overwrite_partitions")
    assert sorted(r["v"] for r in src.read_snapshot(spark, path).collect()) == [1, 3, 5, 20, 40]
    src.publish(places.where("v = 1"), path, KEYS, "append")
    assert sorted(r["v"] for r in src.read_snapshot(spark, path).collect()) == [1, 1, 3, 5, 20, 40]
    with pytest.raises(ValueError, match="another schema"):
        src.publish(places.withColumn("w", F.lit(1)), path, KEYS, "append")
    with pytest.raises(ValueError, match="unknown mode"):
        src.publish(places, path, KEYS, "merge")


def test_a_write_that_dies_leaves_the_old_table(spark, places, tmp_path):
    path = str(tmp_path / "t")
    src.publish(places, path, KEYS)
    broken = places.withColumn("v", F.when(F.col("v") == 3, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        src.publish(broken, path, KEYS, leaf_rows=places.groupBy(*KEYS).agg(F.count("*").alias("n_rows")))
    assert bag(src.read_snapshot(spark, path)) == bag(places) and src.versions(spark, path) == [1]
    src.publish(places.where("v > 2"), path, KEYS)
    assert src.remove_versions(spark, path) == [1]
    assert bag(src.read_snapshot(spark, path)) == bag(places.where("v > 2"))
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1
    with pytest.raises(ValueError, match="no version"):
        src.read_snapshot(spark, path, version=1)


def test_one_partition_reads_its_folders_only(spark, places, tmp_path):
    path = str(tmp_path / "t")
    src.publish(places, path, KEYS)
    one = src.read_snapshot(spark, path, UF="PR", MUNICIPIO="A/B+c d")
    assert [tuple(r) for r in one.collect()] == [(2, "PR", "A/B+c d")]
    assert len(one.inputFiles()) == 1
    assert [r["v"] for r in src.read_snapshot(spark, path, UF=None).collect()] == [4]
    assert [r["v"] for r in src.read_snapshot(spark, path, MUNICIPIO="é=1").collect()] == [5]
    assert src.read_snapshot(spark, path, UF="XX").count() == 0
    assert src.is_snapshot(spark, path) and not src.is_snapshot(spark, str(tmp_path / "none"))


def test_types_of_partition_columns(spark, tmp_path):
    day = dt.date(2020, 2, 29)
    rows = spark.createDataFrame([(7, day, 1.5, "007"), (8, None, 2.5, "x")], "n long, day date, share double, code string")
    src.publish(rows.withColumn("v", F.lit(1)), str(tmp_path / "t"), ["n", "day", "share", "code"])
    back = src.read_snapshot(spark, str(tmp_path / "t"), n=7, day=day, share=1.5)
    assert [tuple(r) for r in back.collect()] == [(7, day, 1.5, "007", 1)]
