"""What files a table consists of."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.operators.names import as_list


def file_inventory(df: DataFrame) -> DataFrame:
    """Path, size in bytes and number of rows of each file that ``df`` is read from."""
    return df.groupBy(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


def parquet_inventory(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """The inventory of the Parquet files below ``paths``, whatever columns they have, by one scan.

    No column is read, so the rows of each file come from its footer. Files without rows are left out.
    """
    none = spark.read.schema("__no_column int").option("recursiveFileLookup", True)
    return file_inventory(none.parquet(*as_list(paths)))


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Path, size and time of each file below ``root``, whatever its format; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select(
        F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")
    )
