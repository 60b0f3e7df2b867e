"""Properties over generated inputs."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabularium import functions as fn
from tabularium import operators as op

few = settings(
    max_examples=8, deadline=None, derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
keys = st.one_of(st.none(), st.integers(0, 3), st.just(1), st.just(1))


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


@few
@given(st.lists(keys, max_size=30), st.lists(keys, max_size=6), st.lists(keys, max_size=25), st.integers(1, 6))
def test_consolidation_size(spark, est, com, par, share):
    frames = [
        frame(spark, [(k, i) for i, k in enumerate(side)], f"k int, {name} int")
        for name, side in (("e", est), ("c", com), ("p", par))
    ]
    a, b, c = Counter(est), Counter(com), Counter(par)
    inner = op.consolidate(*frames, "k", rows_per_task=share)
    got = Counter(tuple(r) for r in inner.select("e", "c", "p").collect())
    want = Counter(
        (i, j, m) for i, x in enumerate(est) for j, y in enumerate(com) for m, z in enumerate(par)
        if x is not None and x == y == z
    )
    assert got == want
    left = op.consolidate(*frames, "k", "left", rows_per_task=share)
    sizes = {k: a[k] * (max(b[k], 1) * max(c[k], 1) if k is not None else 1) for k in a}
    assert Counter(r["k"] for r in left.collect()) == {k: n for k, n in sizes.items() if n}
    total = op.consolidation_profile(
        frames[0].withColumn("id", F.concat_ws("-", "k", "e")), *frames[1:], "k", ["k"], "id"
    )
    assert {r["k"]: r["n_rows"] for r in total.collect()} == {
        k: a[k] * b[k] * c[k] for k in a if k is not None and a[k] * b[k] * c[k]
    }


@few
@given(st.lists(st.one_of(st.none(), st.integers(0, 10**12)), min_size=1), st.integers(1, 14))
def test_padded_keys_have_one_length(values, numbers, width):
    for number, key in zip(numbers, values(numbers, "k long", fn.pad_key(F.col("k"), width)), strict=True):
        assert (key is None) == (number is None or len(str(number)) > width)
        assert key is None or key == str(number).zfill(width)[:width]


pieces = st.sampled_from([r.damaged for r in fn.LEGAL_NATURE_RULES + fn.STREET_TYPE_RULES] + ["�", "ã", " ", "x", "Ó", "ção"])
texts = st.lists(pieces, max_size=6).map("".join)


@few
@given(st.lists(texts, min_size=1, max_size=40))
def test_folding_twice_is_folding_once(values, lines):
    once = values(lines, "t string", fn.fold_accents(F.col("t")))
    assert values(once, "t string", fn.fold_accents(F.col("t"))) == once


@few
@given(st.lists(st.one_of(st.none(), st.dates(dt.date(1700, 1, 1), dt.date(2100, 1, 1))), min_size=1))
def test_no_date_below_the_floor(values, days):
    got = values(days, "d date", fn.floor_date(F.col("d")))
    assert got == [None if d is None else max(d, fn.DATE_FLOOR) for d in days]


@few
@given(st.lists(st.text(alphabet="0123456789-/ abc", max_size=9), min_size=1))
def test_parsed_dates_are_those_the_calendar_has(values, lines):
    def real(text):
        try:
            return dt.datetime.strptime(text, "%Y%m%d").date() if len(text) == 8 and text.isdigit() else None
        except ValueError:
            return None

    assert values(lines, "t string", fn.parse_date(F.col("t"))) == [real(t) for t in lines]


@few
@given(st.lists(st.tuples(keys, st.integers(0, 50)), max_size=30, unique_by=lambda r: r[1]))
def test_first_and_last_of_each_key(spark, rows):
    df = frame(spark, rows, "k int, o int")
    first, last = {}, {}
    for k, o in sorted(rows, key=lambda r: r[1]):
        first.setdefault(k, o)
        last[k] = o
    assert {r["k"]: r["o"] for r in op.dedup_first(df, "k", ["o"]).collect()} == first
    assert {r["k"]: r["o"] for r in op.last_wins(df, "k", ["o"]).collect()} == last


@few
@given(st.lists(st.text(alphabet="ab&;#x0123456789ltgamp<> é", max_size=25), min_size=1))
def test_entities_as_the_html_module_decodes_them(values, lines):
    import html
    import re

    pattern = re.compile(r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);")

    def decode(match):
        name, point = match[1], None
        if name.startswith("#"):
            point = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
            return chr(point) if 0 < point < 0xD800 or 0xE000 <= point <= 0x10FFFF else match[0]
        return html.unescape(match[0]) if name in html.entities.name2codepoint else match[0]

    assert values(lines, "t string", fn.unescape_entities(F.col("t"))) == [pattern.sub(decode, t) for t in lines]
