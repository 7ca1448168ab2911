"""Exact duplicates by a tree-merge of sorted digest runs (DataFrame functions only).

Each input partition is a run of (digest, representative, count). In every round
``fan_in`` neighbouring runs are merged into one: rows of a merged run meet by
digest, are sorted, and equal neighbours collapse to one representative. The
number of runs falls by ``fan_in`` a round, and each task holds only a share of
the digests of a run, so no task and no driver ever sees a whole run.

A class is verified at every level: rows are merged only if SHA-256, a second
independent 64-bit hash and the byte length all agree.

Defined results: a null text counts as empty; rows repeated with the same id are
separate rows, of which one stays; a null id stays only if its class has no other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import materialize

IDENTITY = ["sha", "check", "size"]


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One small row for each document, written once; ``row`` and ``run`` number rows and partitions."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return materialize(docs.select(
        F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("sha"), F.xxhash64(text).alias("check"),
        F.octet_length(text).alias("size"), F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("run")), "digests")


def merge_runs(rows: DataFrame, largest: bool, fan_in: int = 8) -> DataFrame:
    """Classes of equal digests: IDENTITY, keep (struct of id and row), n."""
    best = F.max if largest else F.min
    # a null id sorts last in either order
    order = F.struct(F.col("id").isNotNull() if largest else F.col("id").isNull(), "id", "row")
    runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    level = rows.select("run", *IDENTITY, order.alias("keep"), F.lit(1).cast("long").alias("n"))
    while True:
        level = (level.withColumn("run", F.floor(F.col("run") / fan_in))
                 .groupBy("run", *IDENTITY).agg(best("keep").alias("keep"), F.sum("n").alias("n")))
        runs = -(-runs // fan_in)
        if runs <= 1:
            return level.select(*IDENTITY, F.col("keep.id").alias("keep_id"), F.col("keep.row").alias("keep_row"), "n")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     largest: bool = False, fan_in: int = 8) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, text_key (xxhash64). ``largest``: the largest id stays, else the smallest."""
    rows = digest_rows(docs, id_col, text_col)
    classes = merge_runs(rows, largest, fan_in)
    return rows.join(classes, IDENTITY).select(
        F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), F.col("check").alias("text_key"))
