"""Row filters and null handling."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame

from tabularium.operators.names import as_list, col, cols

# Text for a missing text field, code of the home country, status of an active row.
MISSING_TEXT = "-"
HOME_COUNTRY = 105
ACTIVE = 2


def fill_text(df: DataFrame, value: str = MISSING_TEXT) -> DataFrame:
    """Put ``value`` for null in every string column; other columns keep their nulls."""
    return df.na.fill(value)


def fill_code(df: DataFrame, columns: str | Iterable[str], value: int = HOME_COUNTRY) -> DataFrame:
    """Put ``value`` for null in the given code columns; their types stay."""
    return df.na.fill(value, subset=as_list(columns))


def drop_missing(df: DataFrame, columns: str | Iterable[str]) -> DataFrame:
    """Drop rows with a null in any of ``columns``.

    Written as one null test per column, which Spark hands down to the scan; ``na.drop`` stays above it.
    """
    return df.where(reduce(lambda a, b: a & b, [c.isNotNull() for c in cols(as_list(columns))]))


def active_only(df: DataFrame, column: str, value: object = ACTIVE) -> DataFrame:
    """Rows whose ``column`` equals ``value``; null does not."""
    return df.where(col(column) == value)
