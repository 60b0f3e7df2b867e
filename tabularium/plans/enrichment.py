"""Links, descriptions and phone of each company, from stored search pages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium import functions as fn
from tabularium.operators.dedup import dedup_first, last_wins
from tabularium.operators.names import as_list, col
from tabularium.sources.delimited import read_headed_csv, write_headed_csv

NAME = "NOME_EMPRESA"


def page_results(
    pages: DataFrame,
    keep: str | Iterable[str],
    layout: fn.PageLayout = fn.SEARCH_PAGE,
    html: str = "html",
    drop_last: bool = True,
) -> DataFrame:
    """The ``keep`` columns of each page with ``results`` (see ``extract_results``) and phone ``tel``."""
    return pages.select(
        *[col(c) for c in as_list(keep)],
        fn.extract_results(col(html), layout, drop_last).alias("results"),
        fn.extract_phone(col(html), layout.phone, element=layout.phone_element).alias("tel"),
    )


def unsearchable(
    companies: DataFrame, key: str = "CNPJ", name: str = "NOME FANTASIA", city: str = "MUNICIPIO", state: str = "UF"
) -> DataFrame:
    """``n_rows`` and ``n_companies`` without a search key, which :func:`enrich` leaves out."""
    missing = companies.where(fn.search_key(col(name), col(city), col(state)).isNull())
    return missing.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(col(key)).alias("n_companies"))


def enrich(
    companies: DataFrame,
    found: DataFrame,
    order: Iterable[str],
    page_key: str = "query",
    page_order: Iterable[str] = ("page_id",),
    key: str = "CNPJ",
    name: str = "NOME FANTASIA",
    city: str = "MUNICIPIO",
    state: str = "UF",
) -> DataFrame:
    """One row per company name: ``NOME_EMPRESA, tel, link, descricao``.

    Companies are cut to the first row per ``key`` in ``order``; of those that share a name the
    last one in ``order`` counts. ``found`` is what :func:`page_results` makes of the stored pages,
    with the search key they were stored for in ``page_key``; of several the last in ``page_order``
    counts. ``link`` and ``descricao`` are arrays of equal length in page order. Companies without
    a page have empty arrays and the default phone. Companies without a search key (a missing name,
    city or state) have no name either and are left out; :func:`unsearchable` counts them.

    Whole pages are never shuffled, only what was extracted from them, and both sides hold a
    search key once when they are joined, so no key can pile up in one task.
    """
    order = list(order)
    unique = dedup_first(companies, key, order).withColumn(
        "__search", fn.search_key(col(name), col(city), col(state))
    )
    named = last_wins(
        unique.select("__search", fn.search_name(F.col("__search")).alias(NAME), *[col(o) for o in order]),
        NAME,
        order,
    ).select("__search", NAME)
    named = named.where("__search is not null")

    latest = last_wins(found, page_key, page_order).select(col(page_key).alias("__search"), "results", "tel")

    def part(field: str) -> Column:
        empty = F.array().cast("array<string>")
        return F.coalesce(F.col("results").getField(field), empty).alias(field)

    return named.join(latest, "__search", "left").select(
        NAME, F.coalesce("tel", F.lit(fn.NO_PHONE)).alias("tel"), part("link"), part("descricao")
    )


def enrich_files(
    spark: SparkSession,
    companies: str | Iterable[str],
    pages: DataFrame,
    target: str,
    page_key: str = "query",
    page_order: Iterable[str] = ("page_id",),
    layout: fn.PageLayout = fn.SEARCH_PAGE,
    mode: str = "error",
) -> None:
    """From headed company files and stored pages to headed result files, one row per company name.

    "First" and "last" go by file name and by place in the file.
    """
    rows = read_headed_csv(spark, companies, place="__place")
    found = page_results(pages, [page_key, *page_order], layout)
    write_headed_csv(enrich(rows, found, ["__place"], page_key, page_order), target, key=NAME, mode=mode)
