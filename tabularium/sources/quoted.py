"""Headed CSV files whose quoted fields may hold line breaks, read by many tasks a file.

Whether a byte range starts inside a quoted field depends on all quotes before it, so its reader
cannot know by itself. Two passes find it: the first counts the quotes of each range and adds the counts up
over the ranges of a file (in well-formed CSV every quote changes sides, a doubled one twice); the second reads
the lines of all ranges at once, each told on which side it starts, and cuts them into records. A
record that spans ranges leaves a piece in each of them; the few pieces are joined afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Encodings in which the bytes of quotes and line breaks mean nothing else.
ASCII_BASED = re.compile(r"(?i)utf-?8|us-ascii|iso-8859-\d+|latin-?1|windows-125\d|cp125\d")

_PIECES = "file string, start long, at long, kind int, record binary"
_WHOLE, _END, _INSIDE, _OPEN = range(4)


def lines_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file, start, line``: the lines of each byte range in order, as bytes, cut at ``\\n`` only."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line")
    )


def range_sides(lines: DataFrame) -> tuple[dict[tuple[str, int], bool], set[str]]:
    """Whether each byte range starts inside a quoted field, and the files that end inside one.

    One number per range reaches the driver.
    """
    text = F.col("line").cast("string")
    quotes = F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd")).collect()
    sides, inside = {}, {}
    for file, start, odd in sorted(counts):
        sides[file, start] = inside.get(file, False)
        inside[file] = inside.get(file, False) ^ bool(odd)
    return sides, {f for f, open_ in inside.items() if open_}


def _pieces(lines: DataFrame, sides: dict[tuple[str, int], bool], sep: str) -> DataFrame:
    """Whole records, and pieces of those that span ranges: an end, the inside, or the open last part."""
    target = pa.schema([("file", pa.string()), ("start", pa.int64()), ("at", pa.int64()), ("kind", pa.int32()), ("record", pa.binary())])
    mark = re.escape(sep.encode())
    opening = re.compile(rb'(?:^|' + mark + rb')\s*"(?:[^"]|"")*$', re.DOTALL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, at = None, [], 0
        for batch in batches:
            files, starts, data = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            odd = (pc.count_substring(data, '"').to_numpy(zero_copy_only=False) & 1).astype(bool)
            lines = data.to_pylist()
            out = []
            for file, start, line, turns in zip(files, starts, lines, odd.tolist(), strict=True):
                if (file, start) != place:
                    out += closing(place, at, held)
                    if (file, start) not in sides:
                        raise ValueError(f"the byte ranges of {file} changed after they were counted; keep the spark.sql.files settings")
                    place, at = (file, start), 0
                    held = [None] if sides[place] else []  # None stands for what earlier ranges hold
                if held:
                    held.append(line)
                    if turns:
                        out.append((*place, at, _WHOLE if held[0] is not None else _END, b"\n".join(x for x in held if x is not None)))
                        at, held = at + 1, []
                elif turns:
                    if not opening.search(line):
                        raise ValueError(f"{file} has a quote inside an unquoted field; read it with multi_line='file'")
                    held = [line]
                else:
                    out.append((*place, at, _WHOLE, line))
                    at += 1
            if out:
                yield batch_of(out)
        if out := closing(place, at, held):
            yield batch_of(out)

    def closing(place: tuple | None, at: int, held: list) -> list[tuple]:
        if not held:
            return []
        return [(*place, at, _OPEN if held[0] is not None else _INSIDE, b"\n".join(x for x in held if x is not None))]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)], schema=target)

    return lines.mapInArrow(run, _PIECES)


def records_of(lines: DataFrame, sides: dict[tuple[str, int], bool], sep: str) -> DataFrame:
    """``file, start, at, record``: the records of all files as bytes; records of a file are in order of ``start, at``."""
    pieces = _pieces(lines, sides, sep)
    whole = pieces.where(F.col("kind") == _WHOLE).drop("kind")
    # At most two pieces a byte range.
    opens = F.col("kind") == _OPEN
    chain = F.sum(opens.cast("int")).over(Window.partitionBy("file").orderBy("start", opens)).alias("chain")
    parts = pieces.where(F.col("kind") != _WHOLE).select("file", chain, (~opens).alias("later"), "start", "at", "record")
    ordered = F.array_sort(F.collect_list(F.struct("later", "start", "at", "record")))
    joined = parts.groupBy("file", "chain").agg(ordered.alias("parts"))
    joined = joined.withColumn("record", F.aggregate(
        "parts", F.lit(None).cast("binary"), lambda a, x: F.when(a.isNull(), x["record"]).otherwise(F.concat(a, F.lit(b"\n"), x["record"]))
    ))
    first = F.get("parts", F.lit(0))
    return whole.unionByName(joined.select("file", first["start"].alias("start"), first["at"].alias("at"), "record"))


def decoded(record: Column, encoding: str) -> Column:
    """Bytes as text, without the carriage return of the line's end and a byte order mark."""
    text = record.cast("string") if re.fullmatch(r"(?i)utf-?8|us-ascii", encoding) else F.decode(record, encoding)
    return F.regexp_replace(F.regexp_replace(text, "^﻿", ""), "\r$", "")


def read_split(spark: SparkSession, paths: list[str], names: list[str], sep: str, encoding: str, place: str | None) -> DataFrame | None:
    """All records but the headers as text columns, with their place if asked; nothing if a file's quotes do not pair up."""
    lines = lines_of(spark, paths)
    sides, unpaired = range_sides(lines)
    if unpaired:
        return None
    where = F.struct("file", F.col("start").alias("block"), F.col("at").alias("line"))
    records = records_of(lines, sides, sep).where("start > 0 or at > 0")
    records = records.select(where.alias("place"), decoded(F.col("record"), encoding).alias("record"))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    options = {"sep": sep, "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
    parsed = records.where(F.trim("record") != "").select("place", F.from_csv("record", schema.toDDL(), options).alias("row"))
    columns = [F.col("row").getField(n).alias(n) for n in names]
    return parsed.select(*columns, *([F.col("place").alias(place)] if place else []))
