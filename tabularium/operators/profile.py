"""Looks at a table: nulls, distinct values, row counts, first rows, columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.operators.names import as_list, col, cols

SKETCH_LG = 14


def null_audit(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Null count of each column (NaN counts too in float columns) as rows ``col, n_null``, in one scan."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    names = as_list(columns or df.columns)

    def missing(name: str) -> Column:
        test = col(name).isNull()
        return test | F.isnan(col(name)) if name in floats else test

    counts = df.agg(*[F.count_if(missing(name)).alias(f"n{i}") for i, name in enumerate(names)])
    rows = [F.struct(F.lit(name).alias("col"), F.col(f"n{i}").alias("n_null")) for i, name in enumerate(names)]
    return counts.select(F.inline(F.array(*rows)))


def distinct_values(df: DataFrame, columns: str | Iterable[str]) -> DataFrame:
    return df.select(*cols(as_list(columns))).distinct()


def row_counts(df: DataFrame, by: str | Iterable[str] = ()) -> DataFrame:
    """Number of rows, in all or per value of ``by``."""
    return df.groupBy(*cols(as_list(by))).agg(F.count(F.lit(1)).alias("n_rows"))


def count_sketches(df: DataFrame, by: str | Iterable[str], id_column: str, lg_size: int = SKETCH_LG) -> DataFrame:
    """``by``, ``n_rows`` and ``sketch``: rows and a HyperLogLog sketch of the distinct ids per value of ``by``.

    A sketch has at most ``2 ** lg_size`` registers however many ids there are, is filled before the shuffle, and can be stored
    and merged later. Null ids are not counted. Ids are numbers, texts or binaries.
    """
    return df.groupBy(*cols(as_list(by))).agg(
        F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(col(id_column), F.lit(lg_size)).alias("sketch")
    )


def merge_sketches(parts: Sequence[DataFrame], by: str | Iterable[str] = ()) -> DataFrame:
    """The sketches of several deliveries, or of finer groups, as one per value of ``by``; ids met twice count once."""
    return reduce(DataFrame.unionByName, parts).groupBy(*cols(as_list(by))).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0).cast("bigint")).alias("n_rows"), F.hll_union_agg("sketch", F.lit(True)).alias("sketch")
    )


def estimated_counts(sketches: DataFrame) -> DataFrame:
    """The sketches with ``n_distinct`` in place of ``sketch``.

    The standard error is about ``1.04 / sqrt(2 ** lg_size)`` of the count, 0.8 % by default; small counts are exact.
    """
    return sketches.withColumn("n_distinct", F.hll_sketch_estimate("sketch")).drop("sketch")


def preview(df: DataFrame, n: int, order: Iterable[str | Column]) -> DataFrame:
    """The first ``n`` rows in ``order`` (a top-n that each task cuts down before anything moves)."""
    return df.orderBy(*[col(o) if isinstance(o, str) else o for o in order]).limit(n)


def schema_profile(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of each column."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "pos int, col string, type string, nullable boolean")
