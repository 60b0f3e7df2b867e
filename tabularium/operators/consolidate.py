"""The merge of establishments, companies and partners, and its profile."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.operators.balanced import ROWS_PER_TASK, balanced_join
from tabularium.operators.names import as_list, col, cols


def consolidate(
    establishments: DataFrame,
    companies: DataFrame,
    partners: DataFrame,
    key: str | Iterable[str],
    how: str = "inner",
    spread: Sequence[Iterable[str] | None] | None = None,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """One row per establishment and partner of a company.

    The companies come first, as they add no rows; the fan-out by partners is last. All joins use
    one key, so each table is shuffled once. Companies with very many establishments or partners
    are spread over tasks, see :func:`balanced_join`. ``how="left"`` keeps establishments without
    a company or partners.
    """
    return balanced_join([establishments, companies, partners], key, how, spread, rows_per_task)


def consolidation_profile(
    establishments: DataFrame,
    companies: DataFrame,
    partners: DataFrame,
    key: str | Iterable[str],
    by: str | Iterable[str],
    id_column: str,
) -> DataFrame:
    """Rows and distinct establishments of the consolidation per value of ``by``.

    The consolidation itself is never built: each table is counted per key first, and a company's
    rows are the product of its counts. ``by`` columns come from establishments or companies;
    ``id_column`` identifies an establishment and starts with its company key, so that no two
    companies share a value.
    """
    keys, by = as_list(key), as_list(by)
    from_est = [c for c in by if c in establishments.columns and c not in keys]
    from_com = [c for c in by if c in companies.columns and c not in from_est and c not in keys]
    unknown = set(by) - {*from_est, *from_com, *keys}
    if unknown:
        raise ValueError(f"no such columns in establishments or companies: {sorted(unknown)}")

    rows = F.count(F.lit(1))
    ids = establishments.groupBy(*cols([*keys, *from_est, id_column])).agg(rows.alias("__copies"))
    est = ids.groupBy(*cols([*keys, *from_est])).agg(
        F.sum("__copies").alias("__est"), F.count(col(id_column)).alias("__ids")
    )
    com = companies.groupBy(*cols([*keys, *from_com])).agg(rows.alias("__com"))
    par = partners.groupBy(*cols(keys)).agg(rows.alias("__par"))
    # A company listed with two values of `by` would add its establishments to both, as it should.
    return (
        est.join(com, keys)
        .join(par, keys)
        .groupBy(*cols(by))
        .agg(
            F.sum(F.col("__est") * F.col("__com") * F.col("__par")).alias("n_rows"),
            F.sum("__ids").alias("n_est"),
        )
    )
