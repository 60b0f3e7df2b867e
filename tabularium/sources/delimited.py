"""Delimited text files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.operators.clean import drop_missing
from tabularium.operators.names import as_list, col
from tabularium.sources.quoted import ASCII_BASED, read_split

# Column that holds the raw line of a row that did not fit the schema.
REJECTED = "_rejected"


def read_delimited(
    spark: SparkSession,
    paths: str | Iterable[str],
    schema: str | T.StructType,
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    header: bool = False,
    escape: str = "\\",
    rejects: bool = False,
) -> DataFrame:
    """Files without a header, columns by position; a field that does not fit its type is null.

    Every path must exist. ``escape`` stands before a quote inside a quoted field; give ``'"'`` for
    files that double such quotes. With ``rejects`` the raw text of rows that do not fit the schema
    (bad field, too few or too many fields) is kept in the column ``_rejected``. Spark fills it only
    from the columns a query reads, so select it together with all others, or use
    :func:`reject_counts`.
    """
    reader = (
        spark.read.option("sep", sep)
        .option("encoding", encoding)
        .option("header", header)
        .option("escape", escape)
        .option("mode", "PERMISSIVE")
    )
    if rejects:
        fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = T.StructType([*fields, T.StructField(REJECTED, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", REJECTED)
    return reader.schema(schema).csv(as_list(paths))


def read_lookup(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    header: bool = False,
    escape: str = "\\",
) -> DataFrame:
    """A code table. Rows without a code match nothing and are left out."""
    lookup = read_delimited(spark, path, schema, sep, encoding, header, escape)
    return drop_missing(lookup, lookup.columns[0])


def reject_counts(df: DataFrame) -> DataFrame:
    """Rows and rejected rows per file of a frame read with ``rejects=True``."""
    file = F.col("_metadata.file_path")
    # A field is only tried when its column is read, so the count touches every column.
    fields = [col(c) for c in df.columns if c != REJECTED]
    rejected = F.when(col(REJECTED).isNotNull(), F.xxhash64(*fields))
    return df.groupBy(file.alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(rejected).alias("n_rejected")
    )


def read_headed_csv(
    spark: SparkSession,
    paths: str | Iterable[str],
    sep: str = ",",
    encoding: str = "UTF-8",
    multi_line: bool | str = True,
    place: str | None = None,
) -> DataFrame:
    """Files with a header; every column is text, beside ``place``: the file and a row's order in it, as a struct.

    Line breaks inside quoted fields are part of the value. Large files are still read by many tasks: the
    quotes of all byte ranges are counted first (one job), which tells each range whether it starts inside a
    field (see ``quoted``). That needs files in which quotes inside fields are doubled and unquoted fields
    have none. Where a file's quotes do not pair up, or the encoding is not based on ASCII, every file is read
    by one task as with ``multi_line="file"``; a stray quote that opens a record raises an error
    that names the file. ``multi_line=False`` takes every line for a record, in one pass.
    """
    paths = as_list(paths)
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("escape", '"')
    plain = reader.option("multiLine", bool(multi_line)).csv(paths)
    names = plain.columns
    if place:
        block = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
        plain = plain.select("*", F.struct(*block, F.monotonically_increasing_id().alias("line")).alias(place))
    if multi_line is not True or not ASCII_BASED.fullmatch(encoding) or not names:
        return plain
    found = read_split(spark, paths, names, sep, encoding, place)
    return plain if found is None else found


def write_headed_csv(
    df: DataFrame, path: str, key: str | None = None, mode: str = "error", sep: str = ","
) -> None:
    """Files with a header, ``key`` as the first column, arrays and structs as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    names = df.columns if key is None else [key, *[c for c in df.columns if c != key]]
    types = {f.name: f.dataType for f in df.schema}
    out = [F.to_json(col(c)).alias(c) if isinstance(types[c], nested) else col(c) for c in names]
    (
        df.select(*out)
        .write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .csv(path)
    )
