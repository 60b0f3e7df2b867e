"""Extraction of links, descriptions and phones from stored web pages."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a page without a phone yields.
NO_PHONE = "NAO DISPONIBILIZADO"


# The target of a link, with quotes of either kind or none.
LINK = r"""(?is)<a\b[^>]*?\shref\s*=\s*["']?((?<=")[^"]*|(?<=')[^']*|(?<!["'])[^\s"'>]+)"""


@dataclass(frozen=True)
class PageLayout:
    """Regular expressions that find the parts of a page; group 1 of each is the part.

    Where ``text_element`` or ``phone_element`` is given, the part is cut where that element, which
    the expression has opened, is closed again; elements of the same name may be nested in it.
    ``region`` narrows the page to the part that holds the results (the whole page if absent),
    ``block`` yields one match per result, ``link`` and ``text`` are looked up inside a block,
    ``phone`` anywhere in the page.
    """

    block: str
    link: str = LINK
    text: str = r"(?s)\A(.*)\z"
    phone: str = r"""(?i)\shref\s*=\s*["']?tel:([^"'\s>]+)"""
    region: str | None = None
    text_element: str | None = None
    phone_element: str | None = None


# Ids and class names of the search result page. A block runs to the start of the
# next one, so nested elements stay inside it.
SEARCH_PAGE = PageLayout(
    region=r"""(?is)\bid\s*=\s*["']rso["'](.*?)(?=\bid\s*=\s*["']rhs["']|\z)""",
    block=r"""(?is)<div\b[^>]*\bclass\s*=\s*["']MjjYud["'][^>]*>(.*?)(?=<div\b[^>]*\bclass\s*=\s*["']MjjYud["']|\z)""",
    text=r"""(?is)<div\b[^>]*\bclass\s*=\s*["']VwiC3b yXK7lf MUxGbd yDYNvb lyLwlc lEBKkf["'][^>]*>(.*)""",
    phone=r"""(?is)\bid\s*=\s*["']rhs["'].*?<span\b[^>]*\bclass\s*=\s*["']LrzXr zdqRlf kno-fv["'][^>]*>(.*)""",
    text_element="div",
    phone_element="span",
)

# One token of a page. What a parser does not show (comments to their end or that of the page, declarations,
# scripts and styles) comes first; a tag, with quoted values whole, is group 1.
_REST = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|))*+>"""
_TAG = rf"<[/a-zA-Z]{_REST}"
_TOKEN = (
    r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))|<[!?][^>]*+(?:>|\z)"
    rf"|<(?:script|style)\b{_REST}.*?(?:</(?:script|style)\b[^>]*+>|\z)|({_TAG})"
)
_MARKUP = rf"(?is){_TAG}|<[!?/a-zA-Z][^>]*+>"
_ENTITY = r"\A(#0*[0-9]{1,7}|#[xX]0*[0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"
_ALL = 1 << 30

# The names that pages are full of come first, then those of HTML 4: a map is searched from its start.
_FREQUENT = ["amp", "quot", "lt", "gt", "nbsp", "apos"]
_CHARS = {name[:-1]: text for name, text in html5.items() if name.endswith(";")}
_NAMES = [*_FREQUENT, *sorted(set(name2codepoint) - set(_FREQUENT)), *sorted(set(_CHARS) - set(name2codepoint) - set(_FREQUENT))]
_NAMED = json.dumps({name: _CHARS[name] for name in _NAMES})


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def _code_point(name: Column) -> Column:
    digits = F.substring(name, 2, _ALL)
    point = F.when(F.lower(digits).startswith("x"), F.conv(F.substring(digits, 2, _ALL), 16, 10)).otherwise(digits)
    point = point.try_cast("bigint")
    valid = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))


def _unescape(text: Column) -> Column:
    # `text` is used several times here: pass a column or a lambda's variable, no expression.
    names = F.from_json(F.lit(_NAMED), "map<string,string>")

    def decode(piece: Column) -> Column:
        name, rest = piece["name"], piece["rest"]
        char = F.when(name.startswith("#"), _code_point(name)).otherwise(F.element_at(names, name))
        tail = rest.substr(F.length(name) + 2, F.length(rest))
        return F.coalesce(F.concat(char, tail), F.concat(F.lit("&"), rest))

    pieces = F.transform(
        F.slice(F.split(text, "&"), 2, _ALL),
        lambda rest: F.struct(rest.alias("rest"), F.regexp_extract(rest, _ENTITY, 1).alias("name")),
    )
    decoded = F.concat(F.substring_index(text, "&", 1), F.array_join(F.transform(pieces, decode), ""))
    return F.when(text.contains("&"), decoded).otherwise(text)


def _blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def live_markup(html: Column) -> Column:
    """A page without what a parser does not show: comments, declarations, scripts and styles.

    The page is read token by token, so a comment ends only where it is closed, whatever tags it holds, and one
    that stands in a quoted attribute value is no comment.
    """
    return F.regexp_replace(html, _TOKEN, "$1")


def _markup_removed(text: Column) -> Column:
    return F.regexp_replace(text, _MARKUP, "")


def unescape_entities(col: Column) -> Column:
    """Decode ``&amp;``, ``&#233;``, ``&#xE9;`` and the other named entities, each one once."""
    return _let(col, _unescape)


def strip_tags(col: Column) -> Column:
    """Text of a piece of markup: tags, comments, scripts and styles go, entities are decoded."""
    return _let(_markup_removed(live_markup(col)), _unescape)


def _until_closed(markup: Column, element: str | None) -> Column:
    """``markup`` up to the closing tag of the ``element`` that was opened before it, or whole if it stays open."""
    if element is None:
        return markup
    pieces = F.split(markup, rf"(?i)(?=</?{element}\b)")

    def step(acc: Column, piece: Column) -> Column:
        lower = F.lower(piece)
        change = F.when(lower.rlike(rf"\A</{element}\b"), -1).when(lower.rlike(rf"\A<{element}\b"), 1).otherwise(0)
        depth = F.when(acc["depth"] > 0, acc["depth"] + change).otherwise(acc["depth"])
        return F.struct(depth.alias("depth"), (acc["n"] + F.when(depth > 0, 1).otherwise(0)).alias("n"))

    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"))
    return _let(pieces, lambda p: F.array_join(F.slice(p, F.lit(1), F.aggregate(p, start, step)["n"]), ""))


def extract_links(html: Column, pattern: str = LINK) -> Column:
    """All link targets in page order; those in comments and scripts are none."""
    return F.transform(F.regexp_extract_all(live_markup(html), F.lit(pattern), 1), _unescape)


def extract_results(html: Column, layout: PageLayout, drop_last: bool = True) -> Column:
    """Array of ``(pos, link, descricao)``, one entry per block of the page.

    Link and text are taken from the same block, so they stay together when a block lacks one
    of them (that part is null). ``drop_last`` leaves out the page's last block, which on the
    search page is no result. Comments, scripts and styles are no part of the page.
    """
    live = live_markup(html)
    region = live if layout.region is None else F.regexp_extract(live, layout.region, 1)
    blocks = F.regexp_extract_all(region, F.lit(layout.block), 1)
    if drop_last:
        blocks = _let(blocks, lambda b: F.slice(b, 1, F.greatest(F.size(b) - 1, F.lit(0))))

    # One step per pass: what a later step uses twice is a field by then, not a search to repeat.
    found = F.transform(
        blocks,
        lambda block, pos: F.struct(
            pos.alias("pos"),
            F.regexp_extract(block, layout.link, 1).alias("link"),
            _markup_removed(_until_closed(F.regexp_extract(block, layout.text, 1), layout.text_element)).alias("descricao"),
        ),
    )

    def each_part(step: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda r: F.struct(
            r["pos"].alias("pos"), step(r["link"]).alias("link"), step(r["descricao"]).alias("descricao")
        )

    return F.transform(F.transform(found, each_part(_unescape)), each_part(_blank_to_null))


def extract_phone(
    html: Column, pattern: str = PageLayout.phone, default: str = NO_PHONE, element: str | None = None
) -> Column:
    """First phone of the page, or ``default``. ``element`` is what ``pattern`` has opened, as in :class:`PageLayout`."""
    phone = strip_tags(_until_closed(F.regexp_extract(live_markup(html), pattern, 1), element))
    return F.coalesce(_let(phone, _blank_to_null), F.lit(default))
