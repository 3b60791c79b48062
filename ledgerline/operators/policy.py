"""Column masking and row-level visibility, as plain projections and semi
joins a view can hold."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.text import mask_text


def _masked(c: str, kind: str, salt: str) -> Column:
    col = F.col(f"`{c}`")
    if kind == "mask":
        return mask_text(col)
    if kind == "sha256":
        return F.sha2(F.concat(F.lit(salt), col.cast("string")), 256)
    if kind == "redact":
        return F.when(col.isNull(), F.lit(None).cast("string")).otherwise(F.lit("****"))
    if kind == "last4":
        s = col.cast("string")
        n = F.length(s)
        # a value of up to four characters is all mask: its last four would be the whole of it
        return F.when(n <= 4, F.repeat(F.lit("*"), n)).otherwise(
            F.concat(F.repeat(F.lit("*"), n - 4), F.substring(s, -4, 4)))
    raise ValueError(f"unknown mask kind {kind!r}")


def masked_view(df: DataFrame, masks: Mapping[str, str], salt: str = "") -> DataFrame:
    """Same columns, with the columns in ``masks`` replaced by their masked
    form (``mask``, ``sha256`` behind ``salt``, ``redact`` or ``last4``).

    Names resolve as Spark resolves them (``spark.sql.caseSensitive``); a name
    that matches no column, or one column named twice, raises.
    """
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"

    def fold(name: str) -> str:
        return name if exact else name.lower()

    kinds = {fold(c): kind for c, kind in masks.items()}
    if len(kinds) != len(masks):
        raise ValueError("a column is masked twice")
    unknown = sorted(set(kinds) - {fold(c) for c in df.columns})
    if unknown:
        raise ValueError(f"no such column to mask: {', '.join(unknown)}")
    return df.select(*[_masked(c, kinds[fold(c)], salt).alias(c) if fold(c) in kinds else F.col(f"`{c}`")
                       for c in df.columns])


def row_policy(df: DataFrame, allowed: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key appears in ``allowed``: one lazy semi join;
    Spark broadcasts the allowed list when its size in bytes permits."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(allowed.select(*keys), keys, "left_semi")


def region_policy(customers: DataFrame, nation: DataFrame, region: DataFrame, reader_region: str,
                  nation_key: str = "c_nationkey") -> DataFrame:
    """Customers a reader of ``reader_region`` may see: those whose nation
    lies in that region."""
    allowed = (nation.join(region.filter(F.col("r_name") == F.lit(reader_region)),
                           nation["n_regionkey"] == region["r_regionkey"], "left_semi")
               .select(F.col("n_nationkey").alias(nation_key)))
    return row_policy(customers, allowed, nation_key)


def create_reader_view(spark: SparkSession, view: str, rows: DataFrame, allowed: DataFrame, on: str, group_col: str,
                       variable: str, masks: Mapping[str, str] | None = None, salt: str = "") -> None:
    """A view that shows each reader the rows of the reader's group.

    ``allowed`` lists keys (``on``) per group (``group_col``); the session
    variable ``variable`` names the reader's group and is read when a query on
    the view is analysed, so one view serves every group.  A reader without a
    group (the variable is NULL) sees no row.  ``masks`` as in
    :func:`masked_view`.
    """
    spark.sql(f"DECLARE OR REPLACE VARIABLE {variable} STRING DEFAULT NULL")
    shown = masked_view(rows, masks, salt) if masks else rows
    shown.createOrReplaceTempView(f"{view}__rows")
    allowed.select(on, group_col).createOrReplaceTempView(f"{view}__allowed")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT r.* FROM {view}__rows r
                  LEFT SEMI JOIN (SELECT {on} FROM {view}__allowed WHERE {group_col} = {variable}) a
                  ON r.{on} = a.{on}""")


def read_as(spark: SparkSession, view: str, variable: str, group: str | None) -> DataFrame:
    """The view as a reader of ``group`` sees it."""
    spark.sql(f"SET VARIABLE {variable} = ?", [group])
    return spark.table(view)


def drop_reader_view(spark: SparkSession, view: str, variable: str) -> None:
    """Frames read from the view before stay readable."""
    for name in (view, f"{view}__rows", f"{view}__allowed"):
        spark.catalog.dropTempView(name)
    spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {variable}")
