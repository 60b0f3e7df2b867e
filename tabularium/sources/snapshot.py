"""Partitioned Parquet tables that change from one whole state to the next.

Every write goes to a data folder of its own. A manifest of one file then lists the folders that make up
the table, new ones and kept ones, and the newest manifest is the table. A committed file appears at once, so a reader
finds the old state or the new one, never a mixture, and a job that dies leaves the old one.

    root/data/<id>/UF=PR/MUNICIPIO=X/…      root/manifests/version=7/part-….parquet
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.operators.names import as_list, col
from tabularium.session import remove_path
from tabularium.sources.inventory import list_files
from tabularium.sources.layout import ROWS_PER_FILE
from tabularium.sources.partitioned import write_partitioned

REPLACE, OVERWRITE_PARTITIONS, APPEND = "replace", "overwrite_partitions", "append"

#: A row for each folder (its path below the data folder, its size and its partition values), and one without a folder.
_MANIFEST = "version long, data string, folder string, n_files long, bytes long, values map<string,string>, schema string"
_NULL = "__HIVE_DEFAULT_PARTITION__"
#: Types whose folder name is the plain text of the value.
_PLAIN = (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def _manifests(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{root}/manifests")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def versions(spark: SparkSession, root: str) -> list[int]:
    """The versions that are there, oldest first."""
    found = _manifests(spark, root)
    return [] if found is None else sorted(r[0] for r in found.select("version").distinct().collect())


def _partition_values(folder: Column) -> Column:
    """The values in a folder's path by column; a null value is null."""
    part = lambda x, i: F.element_at(F.split(x, "=", 2), i)
    plain = lambda x: F.url_decode(F.replace(x, F.lit("+"), F.lit("%2B")))
    value = lambda x: F.when(part(x, 2) != _NULL, plain(part(x, 2)))
    return F.map_from_entries(F.transform(F.split(folder, "/"), lambda x: F.struct(plain(part(x, 1)), value(x))))


def _folders(spark: SparkSession, root: str, data: str) -> DataFrame:
    """A row for each folder that has files."""
    files = list_files(spark, f"{root}/data/{data}", "*.parquet")
    folder = F.regexp_extract("file", f"/data/{data}/(.*)/[^/]*$", 1)
    found = files.groupBy(folder.alias("folder")).agg(F.count("*").alias("n_files"), F.sum("bytes").alias("bytes"))
    return found.select(F.lit(data).alias("data"), "folder", "n_files", "bytes", _partition_values(F.col("folder")).alias("values"))


def publish(
    df: DataFrame,
    root: str,
    columns: str | Iterable[str],
    mode: str = REPLACE,
    rows_per_file: int = ROWS_PER_FILE,
    leaf_rows: DataFrame | None = None,
    lookup: str | Iterable[str] = (),
) -> int:
    """Write ``df`` as the next version of the table at ``root`` and return its number.

    ``replace`` makes ``df`` the whole table; folders it has no rows for are gone. ``overwrite_partitions`` keeps
    the folders ``df`` has no rows for, ``append`` keeps all; kept folders are listed again, not copied.
    ``lookup`` is as in ``write_partitioned``. The schema must stay that of the table unless it is replaced. One writer at a time. Old versions stay
    readable until :func:`remove_versions`.
    """
    if mode not in (REPLACE, OVERWRITE_PARTITIONS, APPEND):
        raise ValueError(f"unknown mode {mode}")
    spark, names = df.sparkSession, as_list(columns)
    known = versions(spark, root)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    if known and mode != REPLACE and _rows(spark, root, known[-1]).where("folder is null").first()["schema"] != schema.json():
        raise ValueError(f"the table at {root} has another schema")
    version = known[-1] + 1 if known else 1
    data = f"{version}-{uuid.uuid4().hex}"
    write_partitioned(df, f"{root}/data/{data}", names, "error", rows_per_file=rows_per_file, leaf_rows=leaf_rows, lookup=lookup)
    listed = _folders(spark, root, data)
    if known and mode != REPLACE:
        kept = _rows(spark, root, known[-1]).where("folder is not null").select(listed.columns)
        if mode == OVERWRITE_PARTITIONS:
            kept = kept.join(listed.select("folder"), "folder", "left_anti").select(listed.columns)
        listed = listed.unionByName(kept)
    mark = spark.createDataFrame([(data, schema.json())], "data string, schema string")
    manifest = listed.withColumn("schema", F.lit(None).cast("string")).unionByName(mark, allowMissingColumns=True)
    manifest.coalesce(1).write.mode("error").parquet(f"{root}/manifests/version={version}")
    return version


def _rows(spark: SparkSession, root: str, version: int) -> DataFrame:
    return _manifests(spark, root).where(F.col("version") == version)


def is_snapshot(spark: SparkSession, root: str) -> bool:
    """Whether there is a published table at ``root``."""
    return bool(versions(spark, root))


def read_snapshot(spark: SparkSession, root: str, version: int | None = None, **values: object) -> DataFrame:
    """A version of the table at ``root``, the newest by default; with ``values`` only the folders that have them are read."""
    known = versions(spark, root)
    version = version if version is not None else (known[-1] if known else 0)
    if version not in known:
        raise ValueError(f"no version {version or ''} of a table at {root}")
    rows = _rows(spark, root, version)
    schema = T.StructType.fromJson(json.loads(rows.where("folder is null").first()["schema"]))
    folders = rows.where("folder is not null")
    types = {f.name: f.dataType for f in schema}
    for name, value in values.items():
        there = F.element_at("values", F.lit(name))
        if value is None:
            folders = folders.where(there.isNull())
        elif isinstance(types.get(name), _PLAIN):
            folders = folders.where(there == str(value))
    by_data: dict[str, list[str]] = {}
    for r in folders.select("data", "folder").collect():
        by_data.setdefault(r["data"], []).append(f"{root}/data/{r['data']}/{r['folder']}")
    df = spark.createDataFrame([], schema)
    parts = [spark.read.schema(schema).option("basePath", f"{root}/data/{d}").parquet(*sorted(f)) for d, f in sorted(by_data.items())]
    for i, part in enumerate(parts):
        df = part if i == 0 else df.unionByName(part)
    for name, value in values.items():
        df = df.where(col(name).isNull() if value is None else col(name) == value)
    return df.select(*[col(f.name) for f in schema])


def remove_versions(spark: SparkSession, root: str, keep: int = 1) -> list[int]:
    """Remove all but the newest ``keep`` versions, and data that no kept version lists; returns the versions that went.

    Data of writes that died go as well, so no writer may be at work.
    """
    known = versions(spark, root)
    gone = known[: max(len(known) - max(keep, 1), 0)]
    manifests = _manifests(spark, root)
    if manifests is None:
        return []
    used = {r[0] for r in manifests.where(~F.col("version").isin(gone)).select("data").distinct().collect()}
    name = F.regexp_extract("file", "/data/([^/]*)/", 1)
    there = {r[0] for r in list_files(spark, f"{root}/data").select(name).distinct().collect()}
    for version in gone:
        remove_path(spark, f"{root}/manifests/version={version}")
    for data in there - used:
        remove_path(spark, f"{root}/data/{data}")
    return gone
