"""Dedup and union.

``keep_first`` is ``row_number() = 1``. Spark plans the filter into the window as a
group limit on both sides of the exchange: each map task sends at most one row of a
key, so a key with a third of all rows is no hot reducer, and the input is scanned
and shuffled once. ``keep_first_placed`` shuffles keys and places only, and reads the input twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Exactly one row per ``keys`` (null keys form one group), the first in
    ``order`` (ascending, nulls first); rows that tie on ``order`` leave one of them."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*_cols(order)))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


#: Rows of a file to a bitmap, and bytes of bitmaps that are sent to all tasks at most.
BITMAP_ROWS, SEND_BITMAPS = 1 << 15, 64 << 20


def keep_first_placed(df: DataFrame, keys: list[str], order: list[str], place: str) -> DataFrame:
    """G3 for rows that lie in files: :func:`keep_first` without a shuffle of whole rows.

    ``place`` is a struct (file, row number in it) of each row, and one of ``order``; rows of one place have equal keys. Only keys, order and places are
    shuffled, to find the first row of each key; what is found, a bit for each row of the files, is written to the
    checkpoint folder and sent to all tasks, which filter the rows where they are. Where the bitmaps exceed ``SEND_BITMAPS``
    bytes, or where first rows share a place or have none, whole rows are shuffled.
    """
    narrow = df.select(*dict.fromkeys([*keys, *order, place]))
    number = F.col(f"{place}.row")
    # rows that share their place tie: all of them are counted, and have one bit
    first = narrow.withColumn("_place", F.rank().over(Window.partitionBy(*keys).orderBy(*order))).where("_place = 1").select(
        F.col(f"{place}.file").alias("_file"), (number / BITMAP_ROWS).cast("long").alias("_block"), (number % BITMAP_ROWS).alias("_bit"))
    # dealt out as rows: a bitmap from each task for each block would be more
    bits = materialize(first.repartition("_file", "_block").groupBy("_file", "_block").agg(
        F.bitmap_construct_agg("_bit").alias("_bits"), F.count(F.lit(1)).alias("_n")), "first-rows")
    blocks, shared = bits.agg(F.count(F.lit(1)), F.max((F.col("_n") > F.bitmap_count("_bits")) | F.col("_file").isNull() | F.col("_block").isNull())).first()
    if blocks * BITMAP_ROWS // 8 > SEND_BITMAPS or shared:
        return keep_first(df, keys, order)
    placed = df.withColumns({"_file": F.col(f"{place}.file"), "_block": (number / BITMAP_ROWS).cast("long"), "_bit": (number % BITMAP_ROWS).cast("int")})
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_first = F.getbit(byte, F.col("_bit") % 8) == 1
    return placed.join(F.broadcast(bits.drop("_n")), ["_file", "_block"]).where(is_first).select(df.columns)


def dedup_any(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, any survivor (``dropDuplicates``)."""
    return df.dropDuplicates(keys)


def distinct(df: DataFrame) -> DataFrame:
    """Full-row distinct."""
    return df.distinct()


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Concatenate by column name; a column missing from one input is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
