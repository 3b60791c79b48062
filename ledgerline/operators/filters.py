"""Row filters.  Plain ``isin`` / ``IS NOT NULL`` predicates so Catalyst can push
them into the Parquet scan when they sit on a stored column."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_in(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Keep rows whose ``column`` is in ``values``; NULL is dropped."""
    return df.filter(F.col(column).isin(list(values)))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where every column in ``columns`` is not NULL."""
    cond = None
    for c in columns:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df if cond is None else df.filter(cond)


def ordered_subset(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """Repeatable development subset: the first ``n`` rows by ``order_by``
    (ascending, NULLs first as ``orderBy`` sorts them), for keys of any type.

    Spark keeps at most ``n`` rows per partition before the final merge, or
    sorts by range for a large ``n``; either way it is one lazy plan.
    """
    return df.orderBy(*order_by).limit(n)
