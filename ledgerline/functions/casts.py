"""Safe casts from raw text.  All of them return NULL for bad text instead of
failing the job (ANSI mode makes plain CAST and to_date raise)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: str | Column, to_type: str) -> Column:
    """``try_cast(c AS to_type)``."""
    return _col(c).try_cast(to_type)


def safe_double(c: str | Column) -> Column:
    return safe_cast(c, "double")


def safe_int(c: str | Column) -> Column:
    """Integer text only: ``'36.0'`` gives NULL, a leading blank is allowed."""
    return safe_cast(c, "int")


def strip_cast(c: str | Column, text: str, to_type: str) -> Column:
    """Remove every occurrence of ``text`` (literally), then safe-cast.

    ``strip_cast("int_rate", "%", "double")`` turns ``'13.5%'`` into 13.5 and
    ``strip_cast("term", " months", "int")`` turns ``' 36 months'`` into 36.
    """
    return F.replace(_col(c), F.lit(text), F.lit("")).try_cast(to_type)


def month_date(c: str | Column, pattern: str = "MMM-yyyy") -> Column:
    """Parse month-year text such as ``Dec-2015`` to the first of the month;
    unparseable text gives NULL."""
    return F.try_to_date(_col(c), pattern)
