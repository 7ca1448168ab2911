"""New-key detection (J1-J3) and surrogate key assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialize


#: Keys of a load that are sent to all tasks at most (a few hundred bytes each at the most).
SEND_KEYS = 500_000


def new_rows(incoming: DataFrame, existing: DataFrame, on: list[str],
             null_safe: bool = True) -> DataFrame:
    """Rows of ``incoming`` whose key (one or more columns) is not in ``existing``.

    Written as a ``left_anti`` join, which keeps the full incoming row (so the
    re-join J3 is not needed). ``null_safe`` matches null to null (``<=>``), so a
    null key already in the dimension is not appended again; ``null_safe=False``
    is the reference's rule, where a null key never matches and is always new.
    ``<=>`` is still an equi-join key for Spark: no nested loop.
    """
    ex = existing.select(*[F.col(k).alias(f"_ex_{i}") for i, k in enumerate(on)])
    conds = []
    for i, k in enumerate(on):
        left, right = incoming[k], ex[f"_ex_{i}"]
        conds.append(left.eqNullSafe(right) if null_safe else left == right)
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    return incoming.join(ex, cond, "left_anti")


def known_rows(existing: DataFrame, incoming: DataFrame, on: list[str], n_incoming: int,
               null_safe: bool = True) -> DataFrame:
    """Rows of a stored dimension whose key is among ``incoming``'s (``n_incoming`` rows, one per key).

    The keys of a load of at most ``SEND_KEYS`` are sent to the dimension, which is read where it lies and not
    shuffled, however large it has become; a larger load's keys meet it in a shuffle join.
    """
    keys = incoming.select(*[F.col(k).alias(f"_in_{i}") for i, k in enumerate(on)])
    if n_incoming <= SEND_KEYS:
        keys = F.broadcast(keys)
    conds = [existing[k].eqNullSafe(keys[f"_in_{i}"]) if null_safe else existing[k] == keys[f"_in_{i}"] for i, k in enumerate(on)]
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    return existing.join(keys, cond, "left_semi")


def sent_if_small(df: DataFrame) -> DataFrame:
    """``df``, marked to be sent to all tasks of a join when it has at most ``SEND_KEYS`` rows (a few
    hundred bytes each at the most); a larger one is joined by a shuffle."""
    return F.broadcast(df) if df.count() <= SEND_KEYS else df


def max_key(existing: DataFrame, key: str) -> int:
    """Largest existing surrogate key, 0 for an empty dimension (one scalar to the driver)."""
    v = existing.agg(F.max(key)).first()[0]
    return int(v) if v is not None else 0


def assign_keys(df: DataFrame, key: str, order: list, start: int = 0) -> DataFrame:
    """Add ``key`` = start+1, start+2, ... following ``order`` (a total order).

    Distributed numbering: range-sort by ``order`` and write the result once (one
    file per range partition, numbered in range order, rows sorted inside), read it
    back with each row's file and position in it, count rows per file, and join
    the running sum of these counts (one row per file) back by file name. No step puts
    all rows in one task, the numbering does not depend on how the read is split,
    and a re-run task reads the same files.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    written = materialize(df.orderBy(*[c.asc_nulls_first() for c in order_cols]), "keys")
    pos = written.select("*", F.col("_metadata.file_name").alias("_file"),
                         F.col("_metadata.row_index").alias("_row"))
    # files are named part-<task number>-...; the number, not the text, gives the order
    task = F.regexp_extract("_file", r"^part-(\d+)", 1).cast("long")
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (pos.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).withColumn("_task", task)
                  .select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    return (pos.join(offsets, "_file")
               .withColumn(key, (F.lit(start) + F.col("_offset") + F.col("_row") + F.lit(1)).cast("long"))
               .drop("_file", "_row", "_offset"))
