"""Rounded averages and sums of double columns.

Plain ``round(avg(x), d)`` and ``round(sum(x), d)``: no value is cut, dropped
or refused, whatever its size, and NaN and infinity behave as in any double
aggregate.  Adding doubles is not associative, so a mean that sits on a tie of
the last digit may round either way between partitionings; where that matters,
cast the column to a decimal first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _double(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def rounded(expr: Column, digits: int | None = None) -> Column:
    return F.round(expr, digits) if digits is not None else expr


def rounded_sum(c: str | Column, digits: int | None = None) -> Column:
    return rounded(F.sum(_double(c)), digits)


def rounded_avg(c: str | Column, digits: int | None = None) -> Column:
    return rounded(F.avg(_double(c)), digits)
