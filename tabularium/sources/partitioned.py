"""Parquet laid out by partition columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.operators.names import as_list, col, cols
from tabularium.sources.layout import ROWS_PER_FILE, split_leaves

OVERWRITE_PARTITIONS = "overwrite_partitions"

#: Values of one IN list that Parquet readers test one by one; longer lists are only tested as a range.
_IN_VALUES = 10


def _writer(df: DataFrame, names: list[str], lookup: list[str]) -> DataFrameWriter:
    """A writer by folder. Rows of a file are sorted by ``lookup``, and its row groups get Bloom filters on these columns."""
    if not lookup:
        return df.write.partitionBy(*names)
    writer = df.sortWithinPartitions(*cols([*names, *lookup])).write.partitionBy(*names)
    for name in lookup:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    return writer.option("parquet.bloom.filter.adaptive.enabled", "true")


def write_partitioned(
    df: DataFrame,
    path: str,
    columns: str | Iterable[str],
    mode: str = OVERWRITE_PARTITIONS,
    max_records_per_file: int = 0,
    rows_per_file: int = ROWS_PER_FILE,
    leaf_rows: DataFrame | None = None,
    lookup: str | Iterable[str] = (),
) -> None:
    """Write Parquet with one folder per value of ``columns``, and files of about ``rows_per_file`` rows.

    A folder with more rows is written by several tasks, any other one by one task. The rows of
    each folder are counted first; give ``leaf_rows`` (``columns`` and ``n_rows``) if they are known.

    ``overwrite_partitions`` replaces the folders that ``df`` has rows for and leaves the others,
    so running a job twice is the same as running it once. ``append`` adds to what is there.

    ``lookup`` names columns by which single rows are looked up later, see :func:`read_keys`: files are sorted by
    them and hold Bloom filters on them.
    """
    names = as_list(columns)
    leaves = split_leaves(df, names, rows_per_file, leaf_rows)
    writer = _writer(leaves, names, as_list(lookup)).option("maxRecordsPerFile", max_records_per_file)
    if mode == OVERWRITE_PARTITIONS:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode).option("partitionOverwriteMode", "static")
    writer.parquet(path)


def read_partition(
    spark: SparkSession, root: str, schema: str | T.StructType | None = None, **values: object
) -> DataFrame:
    """Rows of the table at ``root`` whose columns equal ``values``; other folders are not read.

    Partition columns keep their place in the result. Without ``schema`` Spark guesses their types
    from the folder names, which turns a city code like ``007`` into the number 7.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(root)
    for name, value in values.items():
        df = df.where(col(name).isNull() if value is None else col(name) == value)
    return df


def read_keys(
    spark: SparkSession,
    root: str,
    column: str,
    keys: Iterable[object],
    schema: str | T.StructType | None = None,
    **values: object,
) -> DataFrame:
    """Rows of the table at ``root`` whose ``column`` is one of ``keys``; ``values`` are as in :func:`read_partition`.

    Meant for a few keys, which go into the plan as literals. In a table written with ``lookup`` they are held against the
    Bloom filters and the sorted pages, so of each file little more than the pages with these keys is read.
    For keys in a frame use ``keep_known``. A null key matches nothing; no keys give no rows.
    """
    wanted = [k for k in dict.fromkeys(keys) if k is not None]
    parts = [wanted[i : i + _IN_VALUES] for i in range(0, len(wanted), _IN_VALUES)]
    return read_partition(spark, root, schema, **values).where(reduce(lambda a, b: a | b, [col(column).isin(p) for p in parts], F.lit(False)))


def save_table(
    df: DataFrame,
    name: str,
    columns: str | Iterable[str],
    mode: str = "error",
    fmt: str = "parquet",
    path: str | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    leaf_rows: DataFrame | None = None,
) -> None:
    """Save as a catalog table partitioned by ``columns``, at ``path`` if given.

    ``rows_per_file`` and ``leaf_rows`` are as in :func:`write_partitioned`.
    """
    names = as_list(columns)
    writer = split_leaves(df, names, rows_per_file, leaf_rows).write.partitionBy(*names).format(fmt).mode(mode)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
