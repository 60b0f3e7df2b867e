from __future__ import annotations

from pyspark.sql import functions as F

from tabularium import operators as op


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_fill_text_touches_strings_only(spark):
    df = spark.createDataFrame([(None, None, None), ("a", 1, 2.0)], "s string, n short, d double")
    assert rows(op.fill_text(df)) == [("-", None, None), ("a", 1, 2.0)]


def test_fill_code_keeps_the_type(spark):
    df = spark.createDataFrame([(None, None), (7, 8)], "a short, b short")
    filled = op.fill_code(df, "a")
    assert rows(filled) == [(105, None), (7, 8)] and dict(filled.dtypes) == {"a": "smallint", "b": "smallint"}


def test_filters(spark):
    df = spark.createDataFrame([(2, "a", 1), (8, "b", 1), (None, "c", 1), (2, "d", None)], "s short, n string, z int")
    assert [r["n"] for r in op.active_only(df, "s").collect()] == ["a", "d"]
    assert [r["n"] for r in op.drop_missing(df, ["n", "z"]).collect()] == ["a", "b", "c"]


def test_dedup_and_last_wins(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), (None, 4, "d"), (None, 3, "c"), ("m", 5, "e")], "k string, o int, v string")
    assert rows(op.dedup_first(df, "k", ["o"])) == [("k", 1, "a"), ("m", 5, "e"), (None, 3, "c")]
    assert rows(op.last_wins(df, "k", ["o"])) == [("k", 2, "b"), ("m", 5, "e"), (None, 4, "d")]
    assert op.dedup_first(df, "k", [F.col("o").desc()]).columns == df.columns
    assert rows(op.dedup_count(df, "k")) == [(3,)]
    assert rows(op.dedup_count(df, "k", count_nulls=False)) == [(2,)]


def test_dedup_cuts_rows_down_before_the_shuffle(spark, plan):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    text = plan(op.dedup_first(df, "k", ["id"]))
    tree = text[: text.index("(1)", text.index("(1)") + 1)]
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit") and tree.count("WindowGroupLimit") == 2


def test_null_audit_counts_nan_in_float_columns_only(spark):
    df = spark.createDataFrame([(None, float("nan"), "x"), (1, 2.0, None), (None, None, "NaN")], "`a b` int, d double, s string")
    assert rows(op.null_audit(df)) == [("a b", 2), ("d", 2), ("s", 1)]
    assert rows(op.null_audit(df, ["s"])) == [("s", 1)]


def test_profiles(spark):
    df = spark.createDataFrame([(3, "x"), (1, "y"), (2, "x")], "n int, `s t` string")
    assert rows(op.distinct_values(df, "s t")) == [("x",), ("y",)]
    assert rows(op.row_counts(df)) == [(3,)]
    assert rows(op.row_counts(df, "s t")) == [("x", 2), ("y", 1)]
    assert [r["n"] for r in op.preview(df, 2, ["n"]).collect()] == [1, 2]
    assert [tuple(r) for r in op.schema_profile(df).orderBy("pos").collect()] == [
        (0, "n", "int", True), (1, "s t", "string", True)]


def test_preview_is_a_top_n(spark, plan):
    assert "TakeOrderedAndProject" in plan(op.preview(spark.range(100), 5, [F.col("id").desc()]))


def test_sketches_merge_over_deliveries_and_groups(spark):
    one = spark.range(30_000).selectExpr("id % 3 as g", "id as x")
    two = spark.range(15_000, 60_000).selectExpr("id % 3 as g", "id as x")
    parts = [op.count_sketches(df, "g", "x") for df in (one, two)]
    per_group = op.merge_sketches(parts, "g")
    found = {r["g"]: (r["n_rows"], r["n_distinct"]) for r in op.estimated_counts(per_group).collect()}
    assert set(found) == {0, 1, 2} and all(n == 25_000 and abs(d - 20_000) < 800 for n, d in found.values())
    whole = op.estimated_counts(op.merge_sketches([per_group])).first()
    assert whole["n_rows"] == 75_000 and abs(whole["n_distinct"] - 60_000) < 2_400


def test_sketches_of_few_null_or_no_ids(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), ("b", None), (None, "y")], "g string, `i d` string")
    got = rows(op.estimated_counts(op.count_sketches(df, "g", "i d")))
    assert got == [("a", 3, 1), ("b", 1, 0), (None, 1, 1)]
    assert rows(op.estimated_counts(op.merge_sketches([op.count_sketches(df.limit(0), "g", "i d")]))) == [(0, 0)]
