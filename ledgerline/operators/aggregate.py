"""Grouped summaries, rates, top-k and re-aggregation.

Every function is one ``groupBy().agg()``: Spark plans a partial hash
aggregate before the shuffle, so only one row per group and partition crosses
the network whatever the skew of the keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.rounded import rounded_avg, rounded_sum

# measure = (output name, function, input column)
Measure = tuple[str, str, str]


def _measure(name: str, fn: str, col: str, digits: int | None) -> Column:
    if fn == "count":
        out = F.count(F.lit(1)) if col == "*" else F.count(F.col(col))
        return out.alias(name)
    if fn == "avg":
        return rounded_avg(col, digits).alias(name)
    if fn == "sum":
        return rounded_sum(col, digits).alias(name)
    if fn == "min":
        return F.min(F.col(col)).alias(name)
    if fn == "max":
        return F.max(F.col(col)).alias(name)
    raise ValueError(f"unknown aggregate {fn!r}")


def summarise(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure],
              digits: int | None = 2, order: bool = False) -> DataFrame:
    """``GROUP BY keys`` with counts and rounded averages / sums.

    ``("loan_count", "count", "id")`` skips NULL ids like ``count(id)``;
    ``("n", "count", "*")`` counts rows.  Averages and sums are plain
    double aggregates, rounded, see :mod:`ledgerline.functions.rounded`.
    """
    out = df.groupBy(*keys).agg(*[_measure(n, f, c, digits) for n, f, c in measures])
    return out.orderBy(*keys) if order else out


def share(df: DataFrame, keys: Sequence[str], numerator: Column | str,
          denominator: Column | str | None = None, name: str = "rate_pct",
          digits: int = 1, with_counts: bool = True) -> DataFrame:
    """Percentage of rows meeting ``numerator`` among rows meeting
    ``denominator`` (all rows if None), per group.  A group with an empty
    denominator gets NULL."""
    num = F.expr(numerator) if isinstance(numerator, str) else numerator
    den = F.lit(True) if denominator is None else (
        F.expr(denominator) if isinstance(denominator, str) else denominator)
    n_num = F.count_if(F.coalesce(num & den, F.lit(False)))
    n_den = F.count_if(F.coalesce(den, F.lit(False)))
    aggs = [F.round(F.lit(100.0) * n_num / F.nullif(n_den, F.lit(0)), digits).alias(name)]
    if with_counts:
        aggs = [n_num.alias("numerator_rows"), n_den.alias("denominator_rows")] + aggs
    return df.groupBy(*keys).agg(*aggs)


def top_k(df: DataFrame, keys: Sequence[str], k: int, count_name: str = "n") -> DataFrame:
    """Most frequent key combinations; ties broken by the keys so the result
    is repeatable.  Planned as a TakeOrderedAndProject over the (small)
    aggregate."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
    return counts.orderBy(F.col(count_name).desc(), *[F.col(c).asc_nulls_first() for c in keys]).limit(k)


def regroup(df: DataFrame, keys: Sequence[str], sums: Sequence[tuple[str, str]],
            long_sums: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """Re-aggregate an aggregate: ``SUM`` of its measures by coarser keys.
    Names in ``long_sums`` are summed as bigint (counts); the others exactly,
    rounded to ``digits`` if given."""
    aggs = []
    for name, col in sums:
        if name in long_sums:
            aggs.append(F.sum(F.col(col)).cast("bigint").alias(name))
        else:
            aggs.append(rounded_sum(col, digits).alias(name))
    return df.groupBy(*keys).agg(*aggs)
