"""Joins of a large table with a code lookup."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.operators.balanced import balanced_join
from tabularium.operators.names import as_list, col, cols

MAX_BROADCAST_BYTES = 64 << 20


def measured_bytes(*frames: DataFrame) -> list[int]:
    """Size of the rows of each frame, found by one distributed job that returns a number per frame."""

    def width(field: T.StructField) -> Column:
        c = col(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(16)
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + F.lit(16)
        return F.lit(8)

    def size(i: int, df: DataFrame) -> DataFrame:
        per_row = sum((width(f) for f in df.schema), F.lit(16)).cast("bigint")
        return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("bytes")).select(F.lit(i).alias("i"), "bytes")

    sizes = reduce(DataFrame.unionAll, [size(i, df) for i, df in enumerate(frames)])
    return [row["bytes"] for row in sorted(sizes.collect())]


def _join(
    fact: DataFrame, dim: DataFrame, keys: list[str], how: str, fits: bool, spread: Iterable[str] | None = None
) -> DataFrame:
    if fits:
        return fact.join(F.broadcast(dim), keys, how)
    return balanced_join([fact, dim], keys, how, spread=[spread, None] if spread is not None else None)


def join_lookups(
    fact: DataFrame,
    lookups: Sequence[tuple[DataFrame, str | Iterable[str]]],
    how: str = "inner",
    max_bytes: int = MAX_BROADCAST_BYTES,
    spread: Iterable[str] | None = None,
) -> DataFrame:
    """Add the columns of each ``(lookup, key)``; with ``inner``, rows with an unknown or null code go.

    The lookups are measured first, in one job. Those up to ``max_bytes`` are broadcast, so a code
    that most rows share costs nothing; a larger one is joined by a shuffle that spreads such codes.
    ``spread`` names columns of ``fact`` that tell its rows apart (all atomic ones if None).
    """
    sizes = measured_bytes(*[dim for dim, _ in lookups])
    for (dim, key), size in zip(lookups, sizes, strict=True):
        fact = _join(fact, dim, as_list(key), how, size <= max_bytes, spread)
    return fact


def join_lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str | Iterable[str],
    how: str = "inner",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """:func:`join_lookups` with one lookup."""
    return join_lookups(fact, [(dim, key)], how, max_bytes)


def _known(dim: DataFrame, keys: list[str]) -> DataFrame:
    return dim.select(*cols(keys)).distinct()


def keep_known(
    fact: DataFrame, dim: DataFrame, key: str | Iterable[str], max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Rows whose code the lookup lists. A code listed twice does not double rows."""
    keys = as_list(key)
    known = _known(dim, keys)
    return _join(fact, known, keys, "left_semi", measured_bytes(known)[0] <= max_bytes)


def lookup_misses(
    fact: DataFrame, dim: DataFrame, key: str | Iterable[str], max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Codes the lookup does not list, null included, with the number of rows an inner join drops."""
    keys = as_list(key)
    used = fact.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("n_rows"))
    known = _known(dim, keys)
    return _join(used, known, keys, "left_anti", measured_bytes(known)[0] <= max_bytes)
