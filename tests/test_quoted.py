"""Splitting headed CSV files with line breaks inside quoted fields."""

from __future__ import annotations

import csv
import io
import random

import pytest

from tabularium import sources
from tabularium.sources import quoted


@pytest.fixture
def tiny_ranges(spark):
    """Byte ranges of a few dozen bytes, so that records span many of them."""
    settings = {"spark.sql.files.maxPartitionBytes": "40", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def text_of(rows, names, end="\n", sep=","):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, delimiter=sep, quoting=csv.QUOTE_MINIMAL)
    writer.writerow(names)
    writer.writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize(("seed", "end", "encoding"), [(0, "\n", "UTF-8"), (1, "\r\n", "UTF-8"), (2, "\n", "ISO-8859-1"), (3, "\n", "UTF-8")])
def test_values_survive_any_cut(spark, tmp_path, tiny_ranges, seed, end, encoding):
    rng = random.Random(seed)
    parts = ["a", "é", '"', '""', ",", "\n", "\n\n", "x" * 30, " ", ";", 'q"q', "long\ntext, with \"all\"\n" * 5]
    files = []
    for k in range(3):
        rows = [[f"{k}-{i}", *("".join(rng.choice(parts) for _ in range(rng.randint(0, 4))) or "-" for _ in range(2))] for i in range(40)]
        (tmp_path / f"f{k}.csv").write_bytes(text_of(rows, ["id", "a", "b c"], end).encode(encoding))
        files.append(rows)
    got = sources.read_headed_csv(spark, [str(tmp_path / f"f{k}.csv") for k in range(3)], encoding=encoding)
    assert got.columns == ["id", "a", "b c"] and got.rdd.getNumPartitions() > 20
    placed = sources.read_headed_csv(spark, [str(tmp_path / f"f{k}.csv") for k in range(3)], encoding=encoding, place="p")
    assert [r["id"] for r in placed.orderBy("p").collect()] == [r[0] for rows in files for r in rows]
    want = sorted(tuple(r) for rows in files for r in rows)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_one_record_longer_than_many_ranges(spark, tmp_path, tiny_ranges):
    rows = [["1", "line\n" * 200], ["2", "x"], ["3", "\n"]]
    (tmp_path / "f.csv").write_text(text_of(rows, ["id", "text"]))
    assert sorted(tuple(r) for r in sources.read_headed_csv(spark, str(tmp_path / "f.csv")).collect()) == [tuple(r) for r in rows]


def test_written_values_come_back(spark, tmp_path, tiny_ranges):
    rows = [(str(i), 'say "so",\nor\r\nnot' * (i % 4), ["a\nb", 'c"d']) for i in range(60)]
    sources.write_headed_csv(spark.createDataFrame(rows, "id string, text string, tags array<string>"), str(tmp_path / "out"), key="id")
    got = {r["id"]: r for r in sources.read_headed_csv(spark, str(tmp_path / "out")).collect()}
    assert len(got) == 60
    for i, text, _ in rows:
        assert (got[i]["text"] or "") == text
        assert got[i]["tags"] == '["a\\nb","c\\"d"]'


def test_short_rows_blank_lines_and_headers_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿id,text\n1\n\n2,x,too many\n  \n"3","y"')
    got = sources.read_headed_csv(spark, str(tmp_path / "a.csv"))
    assert sorted(tuple(r) for r in got.collect()) == [("1", None), ("2", "x"), ("3", "y")]
    (tmp_path / "b.csv").write_text("id,text\n")
    assert sources.read_headed_csv(spark, str(tmp_path / "b.csv")).collect() == []


def test_stray_quotes(spark, tmp_path):
    (tmp_path / "even.csv").write_text('id,size\n1,5" pipe\n2,plain\n3,7" pipe\n')
    with pytest.raises(Exception, match="quote inside an unquoted field"):
        sources.read_headed_csv(spark, str(tmp_path / "even.csv")).collect()
    assert [r["size"] for r in sources.read_headed_csv(spark, str(tmp_path / "even.csv"), multi_line="file").collect()] == ['5" pipe', "plain", '7" pipe']
    (tmp_path / "odd.csv").write_text('id,size\n1,5" pipe\n2,plain\n')
    assert [r["size"] for r in sources.read_headed_csv(spark, str(tmp_path / "odd.csv")).collect()] == ['5" pipe', "plain"]


def test_other_encodings_are_read_whole(spark, tmp_path):
    (tmp_path / "u.csv").write_bytes(text_of([["1", "é\nü"]], ["id", "t"]).encode("utf-16"))
    assert [tuple(r) for r in sources.read_headed_csv(spark, str(tmp_path / "u.csv"), encoding="UTF-16").collect()] == [("1", "é\nü")]


def test_sides_of_ranges(spark, tmp_path, tiny_ranges):
    text = text_of([[str(i), "a\nb" * 9] for i in range(9)], ["id", "t"])
    (tmp_path / "f.csv").write_text(text)
    sides, unpaired = quoted.range_sides(quoted.lines_of(spark, [str(tmp_path / "f.csv")]))
    assert not unpaired and len(sides) > 3
    for (_, start), inside in sides.items():
        begin = text.find("\n", start - 1) + 1 if start else 0  # a range begins with its first line
        assert inside == bool(text[:begin].count('"') % 2)
