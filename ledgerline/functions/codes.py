"""Code decoding and tiering as JVM-side CASE expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode(c: str | Column, mapping: Mapping[str, str], default: str | None = "Other") -> Column:
    """Replace a code by its label; unknown codes and NULL get ``default``.

    One ``CASE WHEN`` chain of any length; it stays inside whole-stage codegen
    and needs no join.
    """
    col = _col(c)
    items = list(mapping.items())
    if not items:
        return F.lit(default)
    expr = F.when(col == F.lit(items[0][0]), F.lit(items[0][1]))
    for code, label in items[1:]:
        expr = expr.when(col == F.lit(code), F.lit(label))
    return expr.otherwise(F.lit(default))


def tier(c: str | Column, groups: Sequence[tuple[Sequence[str], str]], default: str = "Unknown") -> Column:
    """Label by membership in value lists, first match wins; NULL gets ``default``."""
    col = _col(c)
    expr = None
    for values, label in groups:
        cond = col.isin(list(values))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))
