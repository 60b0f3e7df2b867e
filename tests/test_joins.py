from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabularium import operators as op
from tabularium.operators import balanced
from tabularium.operators.balanced import _CELL, _place
from tabularium.operators.names import as_list


def bag(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows on key 1 in two tables, copies of one row, null keys, keys on one side only."""
    left = spark.range(6000, numPartitions=5).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 97).alias("k"),
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("a"),
    )
    mid = spark.range(80, numPartitions=2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("c"))
    right = spark.range(400, numPartitions=3).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 120).alias("k"),
        F.col("id").alias("b"),
    )
    return left, mid, right


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("share", [1, 7, 100, 10**6])
def test_balanced_join_equals_plain_joins(skewed, how, share):
    got = op.balanced_join(skewed, "k", how, rows_per_task=share)
    want = op.balanced_join(skewed, "k", how, rows_per_task=None)
    assert got.columns == want.columns
    # Rows are many; compare them by count per distinct row, on the cluster.
    both = got.withColumn("n", F.lit(1)).unionAll(want.withColumn("n", F.lit(-1)))
    assert both.groupBy(*want.columns).agg(F.sum("n").alias("n")).where("n != 0").count() == 0
    assert got.count() == want.count()


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_balanced_semi_and_anti_join(skewed, how):
    left, mid, _ = skewed
    for share in (1, 50):
        got = op.balanced_join([left, mid.select("k")], "k", how, rows_per_task=share)
        assert bag(got) == bag(left.join(mid, "k", how))


def test_balanced_join_on_two_keys(spark):
    left = spark.createDataFrame([(1, "x", i) for i in range(50)] + [(2, "y", 1), (None, "x", 2)], "k int, s string, a int")
    right = spark.createDataFrame([(1, "x", i) for i in range(20)] + [(2, "z", 1)], "k int, s string, b int")
    for how in ("inner", "left"):
        got = op.balanced_join([left, right], ["k", "s"], how, rows_per_task=4)
        assert bag(got) == bag(left.join(right, ["k", "s"], how))


def test_join_sides_that_lack_the_hot_key(spark):
    many = spark.createDataFrame([(1, i) for i in range(40)], "k int, a int")
    none = spark.createDataFrame([(2, 0)], "k int, c int")
    some = spark.createDataFrame([(1, i) for i in range(30)], "k int, b int")
    for how in ("inner", "left"):
        for frames in ([many, none, some], [none, many, some], [some, none, many]):
            got = op.balanced_join(frames, "k", how, rows_per_task=5)
            assert bag(got) == bag(op.balanced_join(frames, "k", how, rows_per_task=None))


def test_hot_keys_and_their_cells(skewed):
    counts = [Counter(r["k"] for r in df.select("k").collect()) for df in skewed]
    sizes = {k: [max(c[k], 1) for c in counts] for k in set().union(*counts) if k is not None}
    got = {r[0]: tuple(r)[1:] for r in op.hot_keys(skewed, "k", rows_per_task=100).collect()}
    assert set(got) == {k for k, n in sizes.items() if math.prod(n) > 100}
    for k, cells in got.items():
        assert math.prod(-(-n // c) for n, c in zip(sizes[k], cells, strict=True)) <= 100 * 1.3
    assert got[1][1] == 1 and got[1][0] > 19 and got[1][2] > 2


def test_the_product_of_two_middling_sides_is_spread(spark):
    left = spark.range(1500, numPartitions=3).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    right = spark.range(1500, numPartitions=3).select(F.lit(1).alias("k"), F.col("id").alias("b"))
    joined = op.balanced_join([left, right], "k", rows_per_task=1500)
    loads = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(loads) == 1500 * 1500 and len(loads) >= 6 and max(loads) <= 0.3 * sum(loads)


def test_very_many_hot_keys_change_no_rows(skewed, monkeypatch):
    monkeypatch.setattr(balanced, "MAX_HOT_KEYS", 2)
    found, others = balanced._found_keys(skewed, ["k"], 2, False)
    assert found.count() <= 2 and others.count() > 20
    got = op.balanced_join(skewed, "k", rows_per_task=2)
    want = op.balanced_join(skewed, "k", rows_per_task=None)
    assert got.count() == want.count()
    assert got.agg(F.sum(F.hash("k", "a", "b", "c"))).first() == want.agg(F.sum(F.hash("k", "a", "b", "c"))).first()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_joins_with_a_shuffled_table_of_large_keys(skewed, monkeypatch, how):
    monkeypatch.setattr(balanced, "MAX_HOT_KEYS", 3)
    frames = skewed if "_" not in how else (skewed[0], skewed[1])
    got, want = (op.balanced_join(frames, "k", how, rows_per_task=n) for n in (4, None))
    assert got.columns == want.columns
    counted = lambda df: Counter({tuple(r)[:-1]: r["count"] for r in df.groupBy(*df.columns).count().collect()})
    assert counted(got) == counted(want)


def test_no_task_gets_more_than_its_share_however_many_keys_are_large(spark, monkeypatch):
    monkeypatch.setattr(balanced, "MAX_HOT_KEYS", 10)
    rows = spark.range(200_000, numPartitions=16)
    # A thousand keys that make 10,000 rows each, and one with a fifth of the left rows.
    left = rows.select(F.when(F.col("id") % 5 == 0, -1).otherwise(F.col("id") % 1000).alias("k"), F.col("id").alias("a"))
    right = spark.range(50_000, numPartitions=8).select((F.col("id") % 1000).alias("k"), F.col("id").alias("b"))
    right = right.unionByName(spark.range(40).select(F.lit(-1).alias("k"), F.col("id").alias("b")))
    hot, others = balanced._found_keys([left, right], ["k"], 1000, False)
    assert hot.count() == 1 and others.count() >= 800
    sides = [_place(df, i, 2, ["k"], hot, None, False, others).groupBy("k", _CELL).count() for i, df in enumerate((left, right))]
    made = sides[0].join(sides[1].withColumnRenamed("count", "other"), ["k", _CELL]).select((F.col("count") * F.col("other")).alias("n"))
    top, total = made.agg(F.max("n"), F.sum("n")).first()
    assert top <= 2000
    assert total == left.join(right, "k").count()


def test_rows_of_a_hot_key_are_spread_even_if_they_are_copies(spark):
    copies = spark.range(8000, numPartitions=40).select(F.lit(1).alias("k"), F.lit("same").alias("a"))
    hot = op.hot_keys([copies, copies], "k", rows_per_task=1000)
    placed = _place(copies, 0, 2, as_list("k"), hot, None, False)
    width = hot.first()[1]
    loads = [r["count"] for r in placed.where(F.col(_CELL) < width).groupBy(_CELL).count().collect()]
    assert width > 8 and placed.count() == 8000 * hot.first()[2]
    assert len(loads) >= 20 and max(loads) <= 8000 * 0.2


def test_rows_are_dealt_out_the_same_way_each_time(spark, skewed):
    def dealt(df):
        hot = op.hot_keys([df, skewed[2]], "k", rows_per_task=20)
        return _place(df, 0, 2, ["k"], hot, None, False)

    shuffled = skewed[0].repartition(6, "a")
    for df in (skewed[0], shuffled):
        placed = dealt(df)
        assert bag(placed) == bag(placed) == bag(dealt(df))


def test_rows_without_a_key_are_spread_in_a_left_join(spark):
    left = spark.range(4000, numPartitions=4).select(F.lit(None).cast("int").alias("k"), F.col("id").alias("a"))
    right = spark.createDataFrame([(1, "x")], "k int, b string")
    hot = op.hot_keys([left, right], "k", 1000, first_nulls=True)
    assert [tuple(r) for r in hot.collect()] == [(None, 4, 1)]
    placed = _place(left, 0, 2, ["k"], hot, None, True)
    assert placed.select(_CELL).distinct().count() == placed.count() == 4000
    joined = op.balanced_join([left, right], "k", "left", rows_per_task=1000)
    assert joined.count() == 4000 and joined.where("b is not null").count() == 0


def test_without_hot_keys_the_plan_is_the_plain_one(skewed, plan):
    text = plan(op.balanced_join(skewed, "k"))
    assert "Generate" not in text and "spark_partition_id" not in text.lower()


def test_consolidation_shuffles_each_table_once(spark, plan, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = []
        for i, column in enumerate("abc"):
            path = str(tmp_path / column)
            spark.range(100).select((F.col("id") % 9).alias("k"), F.col("id").alias(column)).write.parquet(path)
            frames.append(spark.read.parquet(path))
        assert plan(op.consolidate(*frames, "k")).count("Arguments: hashpartitioning") == 3
        spread = op.consolidate(*frames, "k", rows_per_task=5)
        assert plan(spread).count("Arguments: hashpartitioning") == 3
        assert spread.count() == sum(n**3 for n in Counter(i % 9 for i in range(100)).values())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unused_columns_are_not_read(spark, plan, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(
        (F.col("id") % 3).alias("k"), F.col("id").alias("id"), F.lit("wide").alias("unused")
    ).write.parquet(path)
    t = spark.read.parquet(path)
    joined = op.balanced_join([t, t.select("k", F.col("id").alias("b"))], "k", rows_per_task=5, spread=[["id"], ["b"]])
    assert "unused" not in "".join(line for line in plan(joined.select("id", "b")).splitlines() if "ReadSchema" in line)


def test_consolidation_fan_out(spark):
    est = spark.createDataFrame([("1", "1a"), ("1", "1b"), ("2", "2a"), ("3", "3a"), ("4", "4a"), (None, "x")], "k string, e string")
    com = spark.createDataFrame([("1", "one"), ("2", "two"), ("4", "four")], "k string, c string")
    par = spark.createDataFrame([("1", "p"), ("1", "q"), ("1", "r"), ("3", "s"), ("4", "t")], "k string, p string")
    for share in (None, 1, 10):
        got = Counter(r["k"] for r in op.consolidate(est, com, par, "k", rows_per_task=share).collect())
        assert got == {"1": 6, "4": 1}
        left = Counter(r["k"] for r in op.consolidate(est, com, par, "k", "left", rows_per_task=share).collect())
        assert left == {"1": 6, "2": 1, "3": 1, "4": 1, None: 1}


def test_consolidation_profile_equals_the_joined_counts(spark):
    est = spark.createDataFrame(
        [("1", "1a", "PR"), ("1", "1b", "SP"), ("1", "1b", "SP"), ("2", "2a", "PR"), ("4", "4a", None), ("5", None, "PR")],
        "k string, id string, uf string")
    com = spark.createDataFrame([("1", "x"), ("1", "y"), ("4", "x"), ("4", "x"), ("5", "z")], "k string, kind string")
    par = spark.createDataFrame([("1", "p"), ("1", "q"), ("4", "p"), ("5", "p")], "k string, p string")
    joined = op.consolidate(est, com, par, "k")
    for by in (["uf"], ["kind"], ["uf", "kind"], ["k"], ["k", "uf"]):
        want = joined.groupBy(*by).agg(F.count("*").alias("n_rows"), F.countDistinct("id").alias("n_est"))
        assert bag(op.consolidation_profile(est, com, par, "k", by, "id")) == bag(want)
    with pytest.raises(ValueError):
        op.consolidation_profile(est, com, par, "k", ["p"], "id")


def test_lookup_join_drops_unknown_and_null_codes(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (9, "d")], "code int, v string")
    dim = spark.createDataFrame([(1, "one"), (2, "two"), (2, "zwei")], "code int, name string")
    for size in (0, 10**6):
        assert bag(op.join_lookup(fact, dim, "code", max_bytes=size)) == bag(fact.join(dim, "code"))
        assert bag(op.join_lookup(fact, dim, "code", "left", size)) == bag(fact.join(dim, "code", "left"))
        assert sorted(r["v"] for r in op.keep_known(fact, dim, "code", size).collect()) == ["a", "b"]
        misses = {r["code"]: r["n_rows"] for r in op.lookup_misses(fact, dim, "code", size).collect()}
        assert misses == {9: 1, None: 1}


def test_small_lookups_are_broadcast_and_large_ones_are_not(spark, plan, tmp_path):
    path = str(tmp_path / "fact")
    spark.range(1000).select((F.col("id") % 7).alias("code"), F.col("id").alias("v")).write.parquet(path)
    fact = spark.read.parquet(path)
    dim = spark.range(5).select(F.col("id").alias("code"), F.lit("x").alias("name"))
    assert "BroadcastHashJoin" in plan(op.join_lookup(fact, dim, "code"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(op.join_lookup(fact, dim, "code"))
        assert "BroadcastHashJoin" not in plan(op.join_lookup(fact, dim, "code", max_bytes=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_measured_bytes(spark):
    df = spark.createDataFrame([(1, "abc", ["x"]), (2, None, None)], "a int, s string, l array<string>")
    big, none = op.measured_bytes(df, df.limit(0))
    assert big > 2 * (16 + 8 + 16) and none == 0
