"""Text columns: money formatting, template filling and masking.

Templates use Python ``str.format`` field syntax (``{name}``,
``{name:,.2f}``) and are turned into one ``concat`` expression on the driver,
so rendering runs inside the JVM for every row.
"""

from __future__ import annotations

import re
import string
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TEXT = "n/a"
_FIXED = re.compile(r"^(,?)\.(\d+)f$")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def plain_text(c: str | Column, null_text: str = NULL_TEXT) -> Column:
    """Value as text, as ``{x}`` prints strings and integers; NULL becomes
    ``null_text``.  Use :func:`double_text` for doubles."""
    return F.coalesce(_col(c).cast("string"), F.lit(null_text))


def _trimmed_decimal(x: Column, scale: int) -> Column:
    """Plain decimal text of a double without trailing zeros, keeping one
    digit after the point (``28316375.0``)."""
    text = F.regexp_replace(x.cast(f"decimal(38,{scale})").cast("string"), r"0+$", "")
    return F.when(text.endswith("."), F.concat(text, F.lit("0"))).otherwise(text)


def double_text(c: str | Column, null_text: str = NULL_TEXT) -> Column:
    """A double as Python's ``str`` prints it: Spark's text switches to
    exponent form below 1e-3 and from 1e7 on, Python only below 1e-4 and from
    1e16 on, so the range in between is written out in plain digits; NaN and
    infinity use Python's spelling."""
    x = _col(c).cast("double")
    ax = F.abs(x)
    out = (F.when(F.isnan(x), F.lit("nan"))
           .when(x == F.lit(float("inf")), F.lit("inf"))
           .when(x == F.lit(float("-inf")), F.lit("-inf"))
           .when((ax >= F.lit(1e7)) & (ax < F.lit(1e16)), _trimmed_decimal(x, 10))
           .when((ax >= F.lit(1e-4)) & (ax < F.lit(1e-3)), _trimmed_decimal(x, 24))
           .otherwise(x.cast("string")))
    return F.coalesce(out, F.lit(null_text))


def fixed_text(c: str | Column, digits: int = 2, grouping: bool = True,
               null_text: str = NULL_TEXT) -> Column:
    """``{x:,.2f}``: grouped thousands, fixed decimals (half-even on the binary
    value, like Python, for magnitudes below 1e15); NaN and infinity spelled
    as Python spells them."""
    x = _col(c).cast("double")
    out = F.format_number(x, digits)
    if not grouping:
        out = F.replace(out, F.lit(","), F.lit(""))
    out = (F.when(F.isnan(x), F.lit("nan")).when(x == F.lit(float("inf")), F.lit("inf"))
           .when(x == F.lit(float("-inf")), F.lit("-inf")).otherwise(out))
    return F.coalesce(out, F.lit(null_text))


def money(c: str | Column, digits: int = 2, null_text: str = NULL_TEXT) -> Column:
    """``$1,234.50``."""
    return F.concat(F.lit("$"), fixed_text(c, digits, True, null_text))


def template_fields(template: str) -> list[str]:
    return [f for _, f, _, _ in string.Formatter().parse(template) if f]


def fill_template(template: str, columns: Mapping[str, str | Column] | None = None,
                  null_text: str = NULL_TEXT, dtypes: Mapping[str, str] | None = None) -> Column:
    """Render a ``str.format`` template against the columns of each row.

    ``columns`` maps a field name to a column (default: the column of the same
    name).  Supported specs: none, ``.Nf`` and ``,.Nf``.  ``dtypes`` (as
    ``dict(df.dtypes)``) marks which plain fields are doubles, so they print
    like Python's ``str``.
    """
    columns = dict(columns or {})
    dtypes = dict(dtypes or {})
    parts: list[Column] = []
    for literal, field, spec, conversion in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is None:
            continue
        if conversion:
            raise ValueError(f"conversion !{conversion} not supported in field {field!r}")
        col = columns.get(field, field)
        if not spec:
            is_double = dtypes.get(field) in ("double", "float")
            parts.append(double_text(col, null_text) if is_double else plain_text(col, null_text))
            continue
        m = _FIXED.match(spec)
        if not m:
            raise ValueError(f"format spec {spec!r} not supported in field {field!r}")
        parts.append(fixed_text(col, int(m.group(2)), bool(m.group(1)), null_text))
    if not parts:
        return F.lit("")
    return F.concat(*parts)


def template_values(columns: Mapping[str, str], null_text: str = NULL_TEXT) -> Column:
    """Map from every placeholder that templates may use (``{name}``, and for
    numbers ``{name:,.2f}`` and ``{name:.2f}``) to its text.  ``columns`` maps
    column names to their types, as ``dict(df.dtypes)`` does."""
    entries: list[Column] = []
    for name, dtype in columns.items():
        is_double = dtype in ("double", "float")
        entries += [F.lit(f"{{{name}}}"), double_text(name, null_text) if is_double else plain_text(name, null_text)]
        if is_double or dtype.startswith("decimal") or dtype in ("tinyint", "smallint", "int", "bigint"):
            for grouping, spec in ((True, ",.2f"), (False, ".2f")):
                entries += [F.lit(f"{{{name}:{spec}}}"), fixed_text(name, 2, grouping, null_text)]
    return F.create_map(*entries)


def fill_from(template: str | Column, values: str | Column) -> Column:
    """Fill a template that is itself a column with a map of
    :func:`template_values`.  Values are put in once and never read as
    placeholders; a placeholder without a value fails the job."""
    values = _col(values)

    def piece(p: Column) -> Column:
        found = F.try_element_at(values, p)
        unknown = F.raise_error(F.concat(F.lit("no value for placeholder: "), p))
        return F.when(~p.startswith("{"), p).when(found.isNotNull(), found).otherwise(unknown)

    return F.array_join(F.transform(F.regexp_extract_all(_col(template), F.lit(r"(\{[^{}]*\}|[^{}]+)"), F.lit(1)), piece), "")


def mask_text(c: str | Column, upper: str = "X", lower: str = "x", digit: str = "n",
              other: str | None = None) -> Column:
    """Replace letters and digits by class characters (``Ab1`` -> ``Xxn``)."""
    col = _col(c)
    if other is None:
        return F.mask(col, F.lit(upper), F.lit(lower), F.lit(digit))
    return F.mask(col, F.lit(upper), F.lit(lower), F.lit(digit), F.lit(other))
