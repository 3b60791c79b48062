"""Data-quality reports: named expectations, layer counts, reconciliation.

Each report is one aggregation pass (no join, no driver loop); ``reconcile``
compares three stored layers, ``reconcile_rows`` checks a chain from one scan.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def expectation_report(df: DataFrame, expectations: Mapping[str, str],
                       null_passes: bool = False) -> DataFrame:
    """Warn-mode expectations: rows are kept, violations are counted.

    ``expectations`` maps a name to a SQL boolean condition.  A row violates
    an expectation when the condition is false, or NULL unless
    ``null_passes``.  Result: expectation, total_rows, passed_rows,
    failed_rows (one row per expectation, in the given order).
    """
    names = list(expectations)
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, name in enumerate(names):
        cond = F.expr(expectations[name])
        ok = F.coalesce(cond, F.lit(null_passes))
        aggs.append(F.count_if(~ok).alias(f"_f{i}"))
    folded = df.agg(*aggs)
    pairs = ", ".join(f"{_sql_str(n)}, _f{i}" for i, n in enumerate(names))
    return (folded
            .selectExpr("_total AS total_rows", f"stack({len(names)}, {pairs}) AS (expectation, failed_rows)")
            .select("expectation", "total_rows",
                    (F.col("total_rows") - F.col("failed_rows")).alias("passed_rows"),
                    "failed_rows"))


def observe_expectations(df: DataFrame, expectations: Mapping[str, str], name: str = "expectations",
                         null_passes: bool = False) -> tuple[DataFrame, Observation]:
    """Attach expectation counters to ``df``; they fill in during whatever
    action writes it, so the check costs no extra scan."""
    obs = Observation(f"{name}_{uuid.uuid4().hex[:12]}")
    metrics = [F.count(F.lit(1)).alias("total_rows")]
    for n, cond in expectations.items():
        metrics.append(F.count_if(~F.coalesce(F.expr(cond), F.lit(null_passes))).alias(n))
    return df.observe(obs, *metrics), obs


def source_shape(df: DataFrame, name: str = "source") -> DataFrame:
    """Row and column count of a source in one pass: (source, row_count,
    column_count)."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("source"), "row_count", F.lit(len(df.columns)).cast("bigint").alias("column_count"))


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named layer: (layer, row_count)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
             for name, df in layers.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reconcile(bronze: DataFrame, silver: DataFrame, gold: DataFrame,
              gold_count_col: str | None = None) -> DataFrame:
    """Cross-layer count check: bronze, silver, gold rows, rows dropped by
    silver, and (if given) the sum of the gold count column, which must
    equal the silver rows when no counted key is NULL.

    Result columns: ``measure`` and ``value`` (bigint).
    """
    gold_aggs = [F.count(F.lit(1)).alias("gold_rows")]
    if gold_count_col:
        gold_aggs.append(F.sum(gold_count_col).cast("bigint").alias("gold_count_sum"))
    rows = (bronze.agg(F.count(F.lit(1)).alias("bronze_rows"))
            .unionByName(silver.agg(F.count(F.lit(1)).alias("silver_rows")), allowMissingColumns=True)
            .unionByName(gold.agg(*gold_aggs), allowMissingColumns=True))
    parts = ["bronze_rows", "silver_rows", "gold_rows"] + (["gold_count_sum"] if gold_count_col else [])
    wide = rows.agg(*[F.max(F.col(n)).cast("bigint").alias(n) for n in parts])
    return _measures(wide, parts)


def reconcile_rows(rows: DataFrame, kept: Column, keys: Sequence[str], id_col: str) -> DataFrame:
    """The same check before anything is stored, from one scan: ``rows`` are
    the typed bronze rows, ``kept`` the condition of the silver filter, ``keys``
    the gold groups and ``id_col`` the column that gold counts.

    One aggregate per group and side of the filter, then one over the groups;
    a condition that is NULL drops the row, as a filter does.
    """
    groups = (rows.groupBy(*keys, F.coalesce(kept, F.lit(False)).alias("__ll_kept"))
              .agg(F.count(F.lit(1)).alias("__ll_n"), F.count(id_col).alias("__ll_ids")))

    def total(c: str, only_kept: bool = True) -> Column:
        value = F.when(F.col("__ll_kept"), F.col(c)) if only_kept else F.col(c)
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    wide = groups.agg(total("__ll_n", False).alias("bronze_rows"), total("__ll_n").alias("silver_rows"),
                      F.count_if("__ll_kept").alias("gold_rows"), total("__ll_ids").alias("gold_count_sum"))
    return _measures(wide, ["bronze_rows", "silver_rows", "gold_rows", "gold_count_sum"])


def _measures(wide: DataFrame, parts: list[str]) -> DataFrame:
    """One row of counts as (measure, value), with the differences."""
    wide = wide.withColumn("dropped_rows", F.col("bronze_rows") - F.col("silver_rows"))
    names = parts + ["dropped_rows"]
    if "gold_count_sum" in parts:
        wide = wide.withColumn("gold_matches_silver",
                               (F.col("gold_count_sum") == F.col("silver_rows")).cast("bigint"))
        names.append("gold_matches_silver")
    pairs = ", ".join(f"'{n}', {n}" for n in names)
    return wide.selectExpr(f"stack({len(names)}, {pairs}) AS (measure, value)")
