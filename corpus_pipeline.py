"""A corpus pipeline of five stages; each is one operator of ``tabularium.llm`` with its production parameters.

Every stage takes ``(spark, docs, sf_dir)``. Its result is written as Parquet and read back as the
next stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabularium.llm import decontamination, langid, packing, pii, simhash
from tabularium.llm.common import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language (no text, or no letter in it); ``lang`` becomes the predicted one."""
    return langid.keep_known(docs, langid.fit(docs, where=langid.training()), lang="lang")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every group of near-duplicates."""
    return simhash.keep_first(docs, simhash.near_duplicates(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that overlap with a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.keep_clean(docs, decontamination.leaks(docs, benchmark))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by the name of its kind."""
    return pii.mask(docs, pii.fit(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place the token pieces of all documents in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("PII", mask_personal_data),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"stage-{name.split()[0].lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language profiles, fingerprints, estimated labelers and a vocabulary cannot be written in SQL.
ORACLE_SQL = None
