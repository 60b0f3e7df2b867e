"""Registry keys and the text lines put together from several columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits of the company, branch and check parts of an establishment key.
KEY_WIDTHS = (8, 4, 2)


def pad_key(col: Column, width: int, overflow: str = "null") -> Column:
    """Numeric key as text with leading zeros.

    A key of more than ``width`` digits becomes null, so it can be counted and never passes for
    another one; ``overflow="keep"`` leaves it whole, ``"cut"`` takes its first ``width`` digits.
    """
    if overflow not in ("null", "keep", "cut"):
        raise ValueError(f"overflow={overflow!r} is not supported")
    text = col.cast("string")
    padded = F.lpad(text, width, "0")
    if overflow == "cut":
        return padded
    longer = F.length(text) > width
    return F.when(longer, text).otherwise(padded) if overflow == "keep" else F.when(~longer, padded)


def compose_key(
    parts: Sequence[Column], widths: Sequence[int] = KEY_WIDTHS, overflow: str = "null"
) -> Column:
    """Padded parts put together; null as soon as one part is null, or too long unless ``overflow`` says otherwise."""
    return F.concat(*[pad_key(part, width, overflow) for part, width in zip(parts, widths, strict=True)])


def activity_label(code: Column, description: Column) -> Column:
    return F.concat_ws(" - ", code, description)


def address_line(street_type: Column, street: Column, number: Column) -> Column:
    """Street type, street and number; missing parts are left out."""
    return F.concat_ws(" ", street_type, street, number.cast("string"))


def place_line(city: Column, state: Column) -> Column:
    return F.concat_ws(" - ", city, state)


def search_key(name: Column, city: Column, state: Column) -> Column:
    """``name, city - state``; null as soon as one part is null."""
    return F.concat(name, F.lit(", "), city, F.lit(" - "), state)


def search_name(key: Column) -> Column:
    """The name a search key starts with, up to its first comma."""
    return F.substring_index(key, ",", 1)
