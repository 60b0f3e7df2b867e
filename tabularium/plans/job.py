"""The whole consolidation, from raw files to partitioned Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.operators.balanced import ROWS_PER_TASK
from tabularium.operators.consolidate import consolidate, consolidation_profile
from tabularium.operators.lookups import lookup_misses
from tabularium.operators.names import col
from tabularium.plans import registry
from tabularium.session import remove_path, scratch_path
from tabularium.sources import schemas
from tabularium.sources.delimited import REJECTED, read_delimited, read_lookup, reject_counts
from tabularium.sources.partitioned import OVERWRITE_PARTITIONS, write_partitioned
from tabularium.sources.snapshot import publish

COMPANY_KEY = "CNPJ BASICO"
PUBLISH = "publish"
_FILE = "__file"
PARTITION_COLUMNS = ["UF", "MUNICIPIO"]
# Columns that tell the rows of one company apart, per table.
SPREAD = [["CNPJ"], ["RAZAO SOCIAL"], ["NOME SOCIO", "CNPJ/CPF DO SOCIO"]]


@dataclass(frozen=True)
class RegistryFiles:
    """Where the raw files are. Fact tables are lists of files, lookups one file each.

    ``header`` and ``escape`` hold for all files but the header of activities; dumps that double the
    quotes inside a field need ``escape='"'``.
    """

    establishments: Sequence[str]
    companies: Sequence[str]
    partners: Sequence[str]
    qualifications: str
    legal_natures: str
    countries: str
    cities: str
    activities: str
    encoding: str = "ISO-8859-1"
    activities_encoding: str = "UTF-8"
    activities_header: bool = False
    header: bool = False
    escape: str = "\\"
    regime: Sequence[str] = ()


def read_registry(spark: SparkSession, files: RegistryFiles) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean establishments, companies and partners. Runs one job per table to measure its lookups."""
    return _clean(_raw(spark, files))


def _clean(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    establishments = registry.establishments(*(tables[n] for n in ("establishments", "countries", "cities", "activities")))
    companies = registry.companies(*(tables[n] for n in ("companies", "qualifications", "legal_natures")))
    return establishments, companies, registry.partners(tables["partners"], tables["qualifications"])


def read_regime(spark: SparkSession, files: RegistryFiles) -> DataFrame:
    """The clean table of the simplified tax regime."""
    return registry.regime(_fact(spark, files, files.regime, schemas.REGIME))


def _fact(spark: SparkSession, files: RegistryFiles, paths: Sequence[str], schema: str, rejects: bool = False) -> DataFrame:
    return read_delimited(spark, paths, schema, encoding=files.encoding, header=files.header, escape=files.escape, rejects=rejects)


def _raw(spark: SparkSession, files: RegistryFiles) -> dict[str, DataFrame]:
    def lookup(path: str, schema: str) -> DataFrame:
        return read_lookup(spark, path, schema, encoding=files.encoding, header=files.header, escape=files.escape)

    return {
        "establishments": _fact(spark, files, files.establishments, schemas.ESTABLISHMENTS),
        "companies": _fact(spark, files, files.companies, schemas.COMPANIES),
        "partners": _fact(spark, files, files.partners, schemas.PARTNERS),
        "qualifications": lookup(files.qualifications, schemas.QUALIFICATIONS),
        "legal_natures": lookup(files.legal_natures, schemas.LEGAL_NATURES),
        "countries": lookup(files.countries, schemas.COUNTRIES),
        "cities": lookup(files.cities, schemas.CITIES),
        "activities": read_lookup(
            spark, files.activities, schemas.ACTIVITIES, sep=",", encoding=files.activities_encoding,
            header=files.activities_header, escape=files.escape,
        ),
    }


_FACTS = {"establishments": schemas.ESTABLISHMENTS, "companies": schemas.COMPANIES, "partners": schemas.PARTNERS}
_LOOKUPS = (
    ("establishments", "cities", "CODIGO_MUNICIPIO"), ("establishments", "countries", "CODIGO_PAIS"),
    ("establishments", "activities", "CNAE PRINCIPAL"), ("companies", "qualifications", "COD QUALIFICACAO SOCIO"),
    ("companies", "legal_natures", "COD NATUREZA JURIDICA"), ("partners", "qualifications", "COD QUALIFICACAO SOCIO"),
)


def _counts(tables: dict[str, DataFrame], rejected: dict[str, DataFrame]) -> DataFrame:
    """The counts of raw tables, and of ``file, n_rejected`` frames for each fact table."""
    parts = [
        df.select(F.lit(f"{name}: rejected").alias("what"), F.col("file").alias("code"), F.col("n_rejected").alias("n_rows"))
        for name, df in rejected.items()
    ]
    for fact, name, key in _LOOKUPS:
        missed = lookup_misses(tables[fact], tables[name], key)
        parts.append(missed.select(F.lit(f"{fact}: not in {name}").alias("what"), col(key).cast("string").alias("code"), "n_rows"))
    return reduce(DataFrame.unionByName, parts).where("n_rows > 0")


def job_counts(spark: SparkSession, files: RegistryFiles) -> DataFrame:
    """``what, code, n_rows``: lines that do not fit their layout, and rows that a lookup drops, by its missing code.

    Rows are counted as they are read, before the other clean-up. Nothing is gathered but counts. This parses the
    text files anew; ``consolidate_files`` can count the rows of the job itself.
    """
    rejected = {n: reject_counts(_fact(spark, files, getattr(files, n), schema, rejects=True)) for n, schema in _FACTS.items()}
    return _counts(_raw(spark, files), rejected)


def _parsed(spark: SparkSession, files: RegistryFiles, folder: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The raw tables with the fact tables parsed once and staged, and the rejected lines of each file."""
    tables, rejected = _raw(spark, files), {}
    for name, schema in _FACTS.items():
        raw = _fact(spark, files, getattr(files, name), schema, rejects=True)
        whole = staged(raw.select("*", F.col("_metadata.file_path").alias(_FILE)), f"{folder}/{name}")
        tables[name] = whole.drop(REJECTED, _FILE)
        rejected[name] = whole.groupBy(F.col(_FILE).alias("file")).agg(F.count(col(REJECTED)).alias("n_rejected"))
    return tables, rejected


def staged(df: DataFrame, folder: str) -> DataFrame:
    """Write ``df`` as Parquet and go on from there."""
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def consolidate_files(
    spark: SparkSession,
    files: RegistryFiles,
    target: str,
    mode: str = OVERWRITE_PARTITIONS,
    rows_per_task: int | None = ROWS_PER_TASK,
    stage: bool = True,
    counts: str | None = None,
) -> DataFrame | None:
    """Read, clean, merge and write by state and city. Running it again leaves the same table.

    With ``mode="publish"`` the result becomes the next version of a published table at ``target``: cities that are no
    longer delivered are gone, and a job that dies half-way leaves the last version. The other modes
    are those of ``write_partitioned``.

    The merge looks at its keys before it joins. With ``stage`` the clean tables are written to the
    shared scratch folder first, so the text files are parsed once, counting reads a few Parquet
    columns, and an executor lost in the merge costs no new parsing. The staged tables are removed
    at the end. Rows per folder are counted from the tables' keys, without building the merge.

    ``counts`` is a folder for the counts of :func:`job_counts`, which are then returned too. They are taken from
    the rows this job reads: the parsed lines are staged once, and counted and cleaned from there, so a task
    that ran twice counts once and the text is still parsed once.
    """
    root = scratch_path(spark, "registry-stage") if stage or counts else None
    try:
        if counts:
            tables, rejected = _parsed(spark, files, f"{root}/parsed")
            _counts(tables, rejected).write.mode("overwrite").parquet(counts)
            frames = _clean(tables)
        else:
            frames = read_registry(spark, files)
        if stage:
            names = ("establishments", "companies", "partners")
            frames = tuple(staged(df, f"{root}/{name}") for name, df in zip(names, frames, strict=True))
        merged = consolidate(*frames, COMPANY_KEY, spread=SPREAD, rows_per_task=rows_per_task)
        leaf_rows = consolidation_profile(*frames, COMPANY_KEY, PARTITION_COLUMNS, "CNPJ")
        if mode == PUBLISH:
            publish(merged, target, PARTITION_COLUMNS, leaf_rows=leaf_rows)
        else:
            write_partitioned(merged, target, PARTITION_COLUMNS, mode, leaf_rows=leaf_rows)
    finally:
        if root:
            remove_path(spark, root)
    return spark.read.parquet(counts) if counts else None
