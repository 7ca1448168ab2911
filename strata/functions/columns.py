"""Column expressions for the silver/gold rules.

Everything returns a native ``Column``: no Python UDF, so the expressions stay
inside whole-stage codegen. ANSI mode is on by default in Spark 4, so element
access uses ``get`` (null when out of range) instead of ``[n]`` (raises).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_of(c: ColumnOrName) -> Column:
    """Element 0 of an array, null when the array is null or empty."""
    return F.get(_c(c), F.lit(0))


def flag(c: ColumnOrName, value) -> Column:
    """1 when the column equals ``value``, else 0 (null gives 0)."""
    return F.when(_c(c) == F.lit(value), F.lit(1)).otherwise(F.lit(0))


def to_long(c: ColumnOrName, strict: bool = True) -> Column:
    """Cast to 64-bit.

    strict: ``cast`` (under ANSI a malformed value fails the job, like the
    reference's ``astype``). lenient: integral text, also with a fraction of
    zeros (``'12.0'``, exact for all 64-bit values); other numbers through double
    (truncated toward zero), else null.
    """
    c = _c(c)
    if strict:
        return c.cast("long")
    whole = F.regexp_replace(c.cast("string"), r"\.0*\s*$", "")
    return F.coalesce(c.try_cast("long"), whole.try_cast("long"), c.try_cast("double").try_cast("long"))


def array_length(c: ColumnOrName) -> Column:
    """number of elements; a null array counts 0."""
    return F.coalesce(F.size(_c(c)), F.lit(0))


def path_level(c: ColumnOrName, n: int, sep: str = "/") -> Column:
    """element ``n`` (0-based) of the path split on ``sep``; null when the path is shorter or null."""
    return F.get(F.split(_c(c), "\\Q" + sep + "\\E"), F.lit(n))


def difference(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a - b`` (null when either side is null)."""
    return _c(a) - _c(b)
