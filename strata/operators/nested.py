"""Nested listing access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import first_of


def flatten(df: DataFrame, spec) -> DataFrame:
    """Select flat columns from struct paths.

    ``spec`` is a list whose items are a column name, a dotted path (the leaf
    name becomes the column name), a ``(name, path_or_column)`` pair, or a
    ``(name, path, "first")`` triple that takes element 0 of an array-of-struct
    field (null when the array is empty or null).
    """
    out: list[Column] = []
    for item in spec:
        if isinstance(item, str):
            out.append(F.col(item).alias(item.rsplit(".", 1)[-1]))
        elif len(item) == 2:
            name, src = item
            out.append((F.col(src) if isinstance(src, str) else src).alias(name))
        else:
            name, src, how = item
            if how != "first":
                raise ValueError(f"unknown access {how!r}")
            out.append(first_of(F.col(src)).alias(name))
    return df.select(*out)
