"""Equi-joins on one key that stay balanced when single keys hold a large share of the rows.

A plain shuffle join sends all rows of a key to one task. Here the rows of each key that is too
large for one task are spread over a grid with one axis per joined table: a table's rows of that
key are dealt out along the table's own axis and repeated along the other axes, so every
combination of rows meets in exactly one grid cell. All other keys have a grid of one cell and
join as usual. The joins of all tables then run on (key, cell) and share one partitioning.

Which keys are large is found first, by one job that counts the key columns (aggregated before its
shuffle). A key is large if its rows, or the result rows it makes (the product of its counts),
are more than ``rows_per_task``. Up to ``MAX_HOT_KEYS`` of them, the largest, are sent to all tasks; rows of
further large keys meet their cells in a shuffle first, which none of these keys can unbalance. Without large keys the plan is that of the plain joins. Cells are
chosen so that one makes at most about ``rows_per_task`` result rows: tables with few rows of the key
are not cut, the others into cells of equal numbers of rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.operators.clean import drop_missing
from tabularium.operators.names import as_list, cols
from tabularium.session import scratch_path

ROWS_PER_TASK = 1_000_000
MAX_HOT_KEYS = 20_000

_CELL = "__cell"


def _split(i: int) -> str:
    return f"__split{i}"


def _hit(i: int) -> str:
    return f"__hit{i}"


def _key_counts(frames: Sequence[DataFrame], keys: list[str], first_nulls: bool) -> DataFrame:
    """Rows per key and table, at least 1 each, and ``__made``: the result rows, as a double."""
    counted = [df if first_nulls and i == 0 else drop_missing(df, keys) for i, df in enumerate(frames)]
    sides = [df.select(*cols(keys), F.lit(i).alias("__side")) for i, df in enumerate(counted)]
    totals = [F.greatest(F.count_if(F.col("__side") == i), F.lit(1)).alias(_split(i)) for i in range(len(frames))]
    counts = reduce(DataFrame.unionByName, sides).groupBy(*cols(keys)).agg(*totals)
    made = reduce(lambda a, b: a * b, [F.col(_split(i)).cast("double") for i in range(len(frames))])
    return counts.withColumn("__made", made)


def _with_cells(counts: DataFrame, keys: list[str], n: int, rows_per_task: float) -> DataFrame:
    """The cells of each table for the keys that make more than ``rows_per_task`` rows.

    With m tables to cut, an edge of ``rows_per_task ** (1 / m)`` rows in each keeps a cell's product
    at ``rows_per_task``. Tables below that edge stay whole, and the others share what they leave.
    """
    sizes = [F.col(_split(i)).cast("double") for i in range(n)]
    several = reduce(lambda a, b: a + b, [F.when(c > 1, 1.0).otherwise(0.0) for c in sizes])
    first = F.pow(F.lit(float(rows_per_task)), 1.0 / F.greatest(several, F.lit(1.0)))
    edged = counts.where(F.col("__made") > rows_per_task).withColumn("__edge", first)
    whole = reduce(lambda a, b: a * b, [F.when(c <= F.col("__edge"), c).otherwise(1.0) for c in sizes])
    cut = reduce(lambda a, b: a + b, [F.when(c > F.col("__edge"), 1.0).otherwise(0.0) for c in sizes])
    edge = F.greatest(F.pow(F.lit(float(rows_per_task)) / whole, 1.0 / F.greatest(cut, F.lit(1.0))), F.lit(1.0))
    shared = edged.withColumn("__shared", edge)
    cells = [
        F.when(c <= F.col("__edge"), 1).otherwise(F.ceil(c / F.col("__shared"))).cast("bigint").alias(_split(i))
        for i, c in enumerate(sizes)
    ]
    return shared.select(*cols(keys), *cells)


def hot_keys(
    frames: Sequence[DataFrame],
    key: str | Iterable[str],
    rows_per_task: int = ROWS_PER_TASK,
    first_nulls: bool = False,
) -> DataFrame:
    """Keys that make more than ``rows_per_task`` result rows, or have as many in a table, and the cells per table.

    Null keys match nothing and are left out, but those of the first frame count with ``first_nulls``.
    """
    keys = as_list(key)
    return _with_cells(_key_counts(frames, keys, first_nulls), keys, len(frames), rows_per_task)


def _found_keys(frames: Sequence[DataFrame], keys: list[str], rows_per_task: int, first_nulls: bool) -> tuple:
    """The cells of the large keys: a local table of fewer than ``MAX_HOT_KEYS`` rows, and a staged one of all others.

    The local one has the largest keys, those that make more than that share of all rows of large keys. No
    key of the other table is more than that, so its rows may meet their cells in a shuffle by key. The
    other table is None while there are few large keys.
    """
    counts = _key_counts(frames, keys, first_nulls)
    large = F.col("__made") > rows_per_task
    seen = counts.agg(F.count_if(large).alias("keys"), F.sum(F.when(large, F.col("__made"))).alias("rows")).first()
    if not seen["keys"]:
        return None, None
    spark = counts.sparkSession
    if seen["keys"] <= MAX_HOT_KEYS:
        cells = _with_cells(counts, keys, len(frames), rows_per_task)
        return spark.createDataFrame(cells.toArrow(), cells.schema), None
    path = scratch_path(spark, "large-keys")
    counts.where(large).write.parquet(path)
    counts = spark.read.schema(counts.schema).parquet(path)
    largest = F.col("__made") > max(rows_per_task, seen["rows"] / MAX_HOT_KEYS)
    cells = _with_cells(counts.where(largest), keys, len(frames), rows_per_task)
    return spark.createDataFrame(cells.toArrow(), cells.schema), _with_cells(counts.where(~largest), keys, len(frames), rows_per_task)


def _hashable(df: DataFrame, keys: Sequence[str]) -> list[str]:
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    return [f.name for f in df.schema if f.name not in keys and not isinstance(f.dataType, nested)]


def _own_cell(df: DataFrame, keys: Sequence[str], spread: Iterable[str] | None) -> Column:
    # Equal rows are told apart by the input partition they sit in. Both parts stay the same when
    # a lost task is run again, which a random number or a running row number would not.
    names = _hashable(df, keys) if spread is None else list(spread)
    return F.xxhash64(F.spark_partition_id(), *cols(names))


def _with_splits(df: DataFrame, keys: Sequence[str], hot: DataFrame, others: DataFrame | None) -> DataFrame:
    """The rows with the cells of their key, null for keys that are not large."""
    if others is None:
        return df.join(F.broadcast(hot), keys, "left")
    names = [c for c in hot.columns if c not in keys]
    no_key = reduce(lambda a, b: a | b, [k.isNull() for k in cols(keys)])
    # Rows of the largest keys, and those without a key, stay out of the shuffle.
    first = df.join(F.broadcast(hot), keys)
    rest = drop_missing(df, keys).join(F.broadcast(hot.select(*cols(keys))), keys, "left_anti").join(others, keys, "left")
    loose = df.where(no_key).withColumns({c: F.lit(None).cast("bigint") for c in names})
    return first.unionByName(rest).unionByName(loose)


def _place(
    df: DataFrame, i: int, n: int, keys: Sequence[str], hot: DataFrame, spread: Iterable[str] | None, outer: bool,
    others_hot: DataFrame | None = None,
) -> DataFrame:
    splits = [F.coalesce(F.col(_split(j)), F.lit(1).cast("bigint")) for j in range(n)]
    stride = reduce(lambda a, b: a * b, splits[:i], F.lit(1).cast("bigint"))
    others = reduce(lambda a, b: a * b, splits[i + 1 :], stride)
    own = F.col("__hash")
    kept = [_split(j) for j in range(1, n)] if outer and i == 0 else []

    salt = F.when(splits[i] > 1, F.pmod(own, splits[i])).otherwise(F.lit(0).cast("bigint"))
    if outer and i == 0:
        # Rows without a key match nothing; any cell will do, so they are dealt out as well.
        no_key = reduce(lambda a, b: a | b, [k.isNull() for k in cols(keys)])
        salt = F.when(no_key, own).otherwise(salt)

    hashed = df.withColumn("__hash", _own_cell(df, keys, spread))
    placed = _with_splits(hashed, keys, hot, others_hot).withColumns(
        {"__own": salt, "__stride": stride, "__width": splits[i], "__others": others}
        | {name: F.coalesce(F.col(name), F.lit(1).cast("bigint")) for name in kept}
    )
    rest = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__others") - 1))
    placed = placed.select(*cols(df.columns), *kept, "__own", "__stride", "__width", rest.alias("__rest"))
    cell = (
        F.col("__own") * F.col("__stride")
        + F.pmod(F.col("__rest"), F.col("__stride"))
        + F.expr("`__rest` div `__stride`") * F.col("__stride") * F.col("__width")
    )
    if outer and i == 0:
        cell = F.when(no_key, F.col("__own")).otherwise(cell)
    return placed.select(*cols(df.columns), *kept, cell.alias(_CELL))


def balanced_join(
    frames: Sequence[DataFrame],
    key: str | Iterable[str],
    how: str = "inner",
    spread: Sequence[Iterable[str] | None] | None = None,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Join ``frames`` from left to right on ``key``; the result is that of the plain joins.

    ``how`` is ``inner`` or ``left``; ``left_semi`` and ``left_anti`` take two frames, of which the
    right one holds each key once. ``spread`` names, per frame, the columns that tell rows of one
    key apart (all atomic columns if None); naming few keeps the others prunable.
    ``rows_per_task=None`` joins without looking for large keys.

    The job that looks for them runs when this function is called.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"how={how!r} is not supported")
    if how.startswith("left_") and len(frames) != 2:
        raise ValueError(f"{how} joins two frames")
    keys = as_list(key)
    outer = how in ("left", "left_anti")
    hot = others = None
    if rows_per_task is not None:
        hot, others = _found_keys(frames, keys, rows_per_task, outer)
    if hot is None:
        return reduce(lambda left, right: left.join(right, keys, how), frames)

    n = len(frames)
    names = list(spread) if spread is not None else [None] * n
    # Literal and staged tables: every side of the join sees the same large keys, whatever is run again.
    frames = [df if outer and i == 0 else drop_missing(df, keys) for i, df in enumerate(frames)]
    placed = [_place(df, i, n, keys, hot, names[i], outer, others) for i, df in enumerate(frames)]
    # Adaptive execution merges partitions that are small on input, whatever they fan out to; it leaves a given number alone.
    tasks = int(hot.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = [df.repartition(tasks, *cols([*keys, _CELL])) for df in placed]

    joined = placed[0]
    for i, right in enumerate(placed[1:], start=1):
        if how == "left":
            joined = joined.join(right.withColumn(_hit(i), F.lit(True)), [*keys, _CELL], "left")
            # A key spread along the right table's axis has rows there, so an unmatched copy of a
            # left row only means that its match sits in another cell.
            joined = joined.where(F.col(_hit(i)).isNotNull() | (F.col(_split(i)) == 1)).drop(_hit(i))
        else:
            joined = joined.join(right, [*keys, _CELL], how)
    return joined.drop(_CELL, *[_split(i) for i in range(1, n)])
