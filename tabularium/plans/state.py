"""One state's part of the consolidated table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tabularium.operators.dedup import dedup_first
from tabularium.sources.partitioned import read_partition
from tabularium.sources.snapshot import is_snapshot, read_snapshot


def state_extract(
    spark: SparkSession,
    root: str,
    state: str,
    order: Iterable[str | Column],
    key: str = "CNPJ",
    state_column: str = "UF",
    schema: str | T.StructType | None = None,
) -> DataFrame:
    """The first row per establishment of one state; only that state's folders are read.

    Where a table was published at ``root``, its newest version is read, with the types it was written with.
    """
    state_only = {state_column: state}
    rows = read_snapshot(spark, root, **state_only) if is_snapshot(spark, root) else read_partition(spark, root, schema, **state_only)
    return dedup_first(rows, key, order)
