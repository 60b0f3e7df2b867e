"""What the operators share: the shared folder, staging, stable hashes and row-wise Arrow mapping."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.session import scratch_path

#: Words are runs of anything but these white-space characters (space, tab to carriage return).
WORD_BREAK = r"[\x20\x09-\x0D]+"

#: A key with more than one in so many of all rows is large, so there are fewer large keys than this.
LARGE_KEYS = 10_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its rows are fixed and survive lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_sized(rows: DataFrame, values: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``values``, which has one row per key and the number of rows of each key in ``size``.

    ``total`` is the sum of the sizes or more. The few large keys are broadcast, so that their rows stay
    where they are read; all others are shuffled. Both inputs are used twice, so both should be cheap to read.
    """
    bound = F.lit(total) / F.lit(LARGE_KEYS)
    large = F.broadcast(values.where(F.col(size) > bound).drop(size))
    others = values.where(F.col(size) <= bound).drop(size)
    return rows.join(large, key).unionByName(rows.join(large.select(key), key, "left_anti").join(others, key))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z only."""
    return F.translate(text, _UPPER, _UPPER.lower())


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def text_slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Small slices of the batches, so that few texts are Python objects at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Map small batches to columns. ``function`` returns a dict of lists or arrays, in the order of ``schema``."""
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            columns = function(batch)
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


_TYPES = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string()),
}


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow schema of column definitions like ``"doc_id long, text string"``."""
    return pa.schema([(name, _TYPES[kind]) for name, kind in (part.split() for part in schema.split(","))])
