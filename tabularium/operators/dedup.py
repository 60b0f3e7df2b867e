"""One row per key.

The ``row_number() = 1`` filter lets Spark keep only each task's best row per key before the
shuffle, so a key that holds a large share of all rows ships one row per input task, not all of
its rows. Give an order that leaves no ties: among tied rows any one may be kept.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.operators.clean import drop_missing
from tabularium.operators.names import as_list, col, cols

_RANK = "__rank"


def _sort_column(order: str | Column) -> Column:
    return col(order) if isinstance(order, str) else order


def dedup_first(df: DataFrame, keys: str | Iterable[str], order: Iterable[str | Column]) -> DataFrame:
    """The first row of each key in ``order``. Rows with a null key form one group."""
    window = Window.partitionBy(*cols(as_list(keys))).orderBy(*[_sort_column(o) for o in order])
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def last_wins(df: DataFrame, keys: str | Iterable[str], order: Iterable[str]) -> DataFrame:
    """The last row of each key in ``order``: a repeated key overwrites what came before."""
    return dedup_first(df, keys, [col(o).desc() for o in order])


def dedup_count(df: DataFrame, keys: str | Iterable[str], count_nulls: bool = True) -> DataFrame:
    """Number of distinct keys as a one-row frame. A null key counts as one value unless told otherwise."""
    keys = as_list(keys)
    values = df if count_nulls else drop_missing(df, keys)
    return values.select(*cols(keys)).distinct().agg(F.count(F.lit(1)).alias("n"))
