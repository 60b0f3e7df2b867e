"""How rows are dealt out over tasks before they are written in folders."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.operators.lookups import MAX_BROADCAST_BYTES, measured_bytes
from tabularium.operators.names import col, cols

ROWS_PER_FILE = 1_000_000

_PIECE = "__piece"
_PIECES = "__pieces"


def _value(i: int) -> str:
    return f"__leaf{i}"


def split_leaves(
    df: DataFrame, columns: Sequence[str], rows_per_file: int = ROWS_PER_FILE, leaf_rows: DataFrame | None = None
) -> DataFrame:
    """``df`` in tasks by leaf, a leaf of more than ``rows_per_file`` rows in as many pieces as it needs.

    The rows of each leaf are counted, not guessed from block sizes, and every (leaf, piece) goes to
    one task, with adaptive execution on or off. ``leaf_rows`` has the counts (``columns`` and
    ``n_rows``) where they are known; else ``df`` is counted first, which runs its plan a second time.
    Only leaves that are split are sent to the tasks: one at most per ``rows_per_file`` rows.
    """
    names = list(columns)
    if leaf_rows is None:
        leaf_rows = df.groupBy(*cols(names)).agg(F.count(F.lit(1)).alias("n_rows"))
    pieces = F.ceil(col("n_rows") / F.lit(rows_per_file)).cast("bigint")
    leaves = leaf_rows.select(*[col(c).alias(_value(i)) for i, c in enumerate(names)], "n_rows", pieces.alias(_PIECES))
    total = leaves.agg(F.sum("n_rows").alias("rows"), F.sum(_PIECES).alias("pieces")).first()
    wanted = max(2 * math.ceil((total["rows"] or 0) / rows_per_file), df.sparkSession.sparkContext.defaultParallelism)
    tasks = max(1, min(int(total["pieces"] or 1), wanted))
    large = leaves.where(F.col(_PIECES) > 1).drop("n_rows")
    if (total["rows"] or 0) <= rows_per_file:
        return df.repartition(tasks, *cols(names))

    if measured_bytes(large)[0] <= MAX_BROADCAST_BYTES:
        large = F.broadcast(large)
    same = [col(c).eqNullSafe(F.col(_value(i))) for i, c in enumerate(names)]
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    atoms = [f.name for f in df.schema if not isinstance(f.dataType, nested)]
    # Equal rows are told apart by the input partition they sit in; both stay the same when a task is run again.
    own = F.xxhash64(F.spark_partition_id(), *cols(atoms))
    piece = F.pmod(F.col("__own"), F.coalesce(F.col(_PIECES), F.lit(1).cast("bigint")))
    dealt = df.withColumn("__own", own).join(large, same, "left").select(*cols(df.columns), piece.alias(_PIECE))
    return dealt.repartition(tasks, *cols(names), F.col(_PIECE)).drop(_PIECE)
