"""Dates that arrive as ``yyyyMMdd`` text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earliest date kept, and the spellings that stand for "no date".
DATE_FLOOR = dt.date(1900, 1, 1)
NO_DATE = ("-", "", "0", "00000000")


def parse_date(col: Column, fmt: str = "yyyyMMdd") -> Column:
    """Text to date, null for anything that is no date.

    The frequent no-date spellings are answered without the parser, which would otherwise
    build and swallow one exception per such row.
    """
    return F.when(~col.isin(*NO_DATE), F.try_to_date(col, fmt))


def year_of(col: Column) -> Column:
    return F.year(col)


def month_of(col: Column) -> Column:
    return F.month(col)


def floor_date(col: Column, floor: dt.date = DATE_FLOOR, mode: str = "clamp") -> Column:
    """Dates up to ``floor`` become ``floor`` (``clamp``) or null (``null``). A null date stays null."""
    if mode not in ("clamp", "null"):
        raise ValueError(f"mode must be 'clamp' or 'null', not {mode!r}")
    low = F.lit(floor) if mode == "clamp" else F.lit(None).cast("date")
    return F.when(col <= F.lit(floor), low).otherwise(col)
