"""Shards along a Hilbert curve over several metadata dimensions, in DataFrame operations only.

Each dimension is cut at its quantiles into ``2 ** bits`` cells; rows are ordered by the index of
their cell on the curve and the order is cut into runs. Neighbours on the curve are neighbours in every
dimension, so a shard covers a narrow range of each, and files can be pruned by any of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.llm.common import stage

BITS = 5
_ACCURACY = 10_000
#: The part of ``monotonically_increasing_id`` that counts rows within a partition.
_ROW = (1 << 33) - 1


def value_edges(df: DataFrame, name: str, parts: int) -> list:
    """The values at the ``1 / parts, 2 / parts, ...`` quantiles of all rows with one, in the order of the values.

    Values are counted and sorted in ranges; a number per range and at most ``parts`` values reach the driver.
    """
    values = df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("v")).agg(F.count("*").alias("n"))
    ordered = values.repartitionByRange("v").sortWithinPartitions("v").withColumn("part", F.spark_partition_id())
    ordered = stage(ordered, "values")
    before, total = {}, 0
    for part, n in sorted(ordered.groupBy("part").agg(F.sum("n")).collect()):
        before[part], total = total, total + n
    if not total:
        return []
    first = F.element_at(F.create_map(*[F.lit(x).cast("long") for item in before.items() for x in item]), F.col("part").cast("long"))
    sums = ordered.withColumn("upto", first + F.sum("n").over(Window.partitionBy("part").orderBy("v")))
    place = F.expr(f"(upto * {parts}L) div {total}L")
    crossed = sums.withColumn("to", place).withColumn("from", F.expr(f"((upto - n) * {parts}L) div {total}L"))
    edges = []
    for v, begin, end in sorted(crossed.where("`to` > `from`").select("v", "from", "to").collect(), key=lambda r: r[1]):
        edges += [v] * (min(end, parts - 1) - begin)
    return edges


def quantise(df: DataFrame, dimensions: Sequence[str], bits: int = BITS) -> list[Column]:
    """The cell of each dimension, 0 to ``2 ** bits - 1``, with edges at the quantiles of all rows. Nulls are in cell 0.

    Numbers are cut at approximate quantiles of their values; all other types by the rank of the whole value as text.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    number = {d: isinstance(df.schema[d].dataType, T.NumericType) for d in dimensions}
    aggregates = [F.percentile_approx(F.col(d).cast("double"), shares, _ACCURACY).alias(f"e{i}") for i, d in enumerate(dimensions) if number[d]]
    numeric = df.agg(*aggregates).first() if aggregates else {}

    def cell(i: int, name: str) -> Column:
        kind = "double" if number[name] else "string"
        cuts = numeric[f"e{i}"] if number[name] else value_edges(df.select(F.col(name).cast("string").alias(name)), name, 1 << bits)
        value = F.col(name).cast(kind)
        known = F.array(*[F.lit(c) for c in cuts or []]).cast(f"array<{kind}>")
        return F.when(value.isNull(), 0).otherwise(F.size(F.filter(known, lambda e: e < value)))

    return [cell(i, d) for i, d in enumerate(dimensions)]


def with_curve_index(df: DataFrame, cells: Sequence[Column], bits: int = BITS, name: str = "curve") -> DataFrame:
    """``df`` with the position on the Hilbert curve of a cell given by its coordinates of ``bits`` bits each.

    Skilling's construction: turn and reflect the coordinates level by level, Gray-encode them, and
    interleave their bits. Each step is a column of its own, so that none is computed twice.
    """
    n = len(cells)
    one = F.lit(1).cast("long")
    levels = [1 << b for b in range(bits - 1, 0, -1)]
    turns = F.array(*[F.struct(F.lit(q).cast("long").alias("q"), F.lit(i).alias("i")) for q in levels for i in range(n)])

    def turn(x: Column, step: Column) -> Column:
        low = step["q"] - 1
        own = F.get(x, step["i"])
        swap = F.get(x, F.lit(0)).bitwiseXOR(own).bitwiseAND(low)
        return F.when(
            own.bitwiseAND(step["q"]) != 0, F.transform(x, lambda v, j: F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
        ).otherwise(F.transform(x, lambda v, j: F.when((j == 0) | (j == step["i"]), v.bitwiseXOR(swap)).otherwise(v)))

    def xor(columns: Sequence[Column]) -> Column:
        return reduce(lambda a, c: a.bitwiseXOR(c), columns)

    kept = df.columns
    point = F.array(*[c.cast("long") for c in cells])
    turned = df.select(*kept, (F.aggregate(turns, point, turn) if levels else point).alias("__t"))
    gray = turned.select(*kept, F.array(*[xor([F.get("__t", F.lit(j)) for j in range(i + 1)]) for i in range(n)]).alias("__g"))
    last = F.get("__g", F.lit(n - 1))
    flips = [F.when(last.bitwiseAND(F.lit(q).cast("long")) != 0, F.lit(q - 1).cast("long")).otherwise(F.lit(0).cast("long")) for q in levels]
    flipped = gray.select(*kept, "__g", (xor(flips) if flips else F.lit(0).cast("long")).alias("__f"))
    final = flipped.select(*kept, F.transform("__g", lambda v: v.bitwiseXOR(F.col("__f"))).alias("__x"))
    taken = [F.shiftright(F.get("__x", F.lit(i)), b).bitwiseAND(one) for b in range(bits - 1, -1, -1) for i in range(n)]
    index = reduce(lambda a, c: a.bitwiseOR(c), [F.shiftleft(c, len(taken) - 1 - k) for k, c in enumerate(taken)])
    return final.select(*kept, index.alias(name))


def hilbert_order(df: DataFrame, dimensions: Sequence[str], ties: Sequence[str] = (), bits: int = BITS) -> DataFrame:
    """``df`` with ``curve`` and ``rank``, the place of each row (from 0) in the order along the curve.

    Rows of one cell are in order of ``ties``; rows that are alike in those keep the order in which they
    are read. The rows are sorted in range partitions; only the number of rows of each
    partition is gathered. Keep ``df`` narrow: all its columns are sorted and written.
    """
    df = stage(df, "narrow")
    cells = quantise(df, dimensions, bits)
    indexed = df.withColumns({f"__c{i}": c for i, c in enumerate(cells)})
    names = [f"__c{i}" for i in range(len(cells))]
    indexed = with_curve_index(indexed, [F.col(c) for c in names], bits).drop(*names)
    keys = ["curve", *ties, "__read"]
    # Written, so that drawing the ranges does not compute the curve a second time.
    indexed = stage(indexed.withColumn("__read", F.monotonically_increasing_id()), "indexed")
    ordered = indexed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = ordered.drop("__read").withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW))})
    ordered = stage(ordered, "curve")
    sizes = ordered.groupBy("__part").agg(F.count("*").alias("__n"))  # a row for each task of the sort
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first")))
    return ordered.join(starts, "__part").withColumn("rank", F.col("__first") + F.col("__at")).drop("__part", "__at", "__first")


def cut_runs(ranked: DataFrame, shards: int) -> DataFrame:
    """``shard`` and ``slot``: the order cut into ``shards`` runs whose numbers of rows differ by one at most."""
    n = ranked.count()
    shard = F.expr(f"(rank * {shards}L) div {max(n, 1)}L")
    first = F.expr(f"(shard * {max(n, 1)}L + {shards - 1}L) div {shards}L")
    return ranked.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("rank") - first)


def shard_documents(docs: DataFrame, shards: int = 24, dimensions: Sequence[str] = ("source", "lang", "n_chars"), text: str = "text", id_col: str = "doc_id", bits: int = BITS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, curve`` and the dimensions, one row per row of ``docs``.

    ``size`` is the length of the text in UTF-8 bytes (null: 0) plus 8, and is a dimension itself. The law is
    ``rows``: numbers of rows differ by one at most. Equal texts may lie in different shards. An empty table gives an empty result.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(content) + 8).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"), *[F.col(d).alias(f"dim_{d}") for d in dimensions],
    )
    ranked = hilbert_order(narrow, [f"dim_{d}" for d in dimensions] + ["size"], ["doc_id", "text_crc32"], bits)
    return cut_runs(ranked, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve",
        *[f"dim_{d}" for d in dimensions],
    )


def write_shards(docs: DataFrame, path: str, placed: DataFrame, id_col: str = "doc_id") -> None:
    """Write the documents in a folder for each shard, in the order of the curve, for pruning by the dimensions."""
    place = placed.select(F.col("doc_id").alias("__id"), "shard", "slot").dropDuplicates(["__id"])
    sized = docs.join(place, docs[id_col].eqNullSafe(place["__id"])).drop("__id")
    sized.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").drop("slot").write.partitionBy("shard").parquet(path)
