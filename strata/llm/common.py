"""Helpers shared by the operators of this package.

Operators take (frame, id column, text column), select just those two, and so are
indifferent to further columns. Work inside a task goes over slices of an Arrow
batch of bounded size: words are split and numbered by Arrow, then handled as
integer arrays, so that per-word Python work is done once for each distinct word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import materialize

SLICE_BYTES = 8 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % n


def two_columns(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """The id and the text under fixed names ``id`` and ``text``; null texts count as empty."""
    return df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)


def slices(batches, column: str = "text", most: int = SLICE_BYTES, most_rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows whose ``column`` holds about ``most`` bytes; a longer text stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(size):
            done = size[at - 1] if at else 0
            to = min(at + most_rows, max(at + 1, int(np.searchsorted(size, done + most, side="right"))))
            yield batch.slice(at, to - at)
            at = to
    # the worker stays for later tasks: what this one used goes back to the system
    pa.default_memory_pool().release_unused()


def word_table(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, word number of each occurrence, bounds): text i has occurrences bounds[i]:bounds[i+1].

    Words are maximal runs of bytes outside \\x20 and \\x09-\\x0D.
    """
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy()
    bounds = np.concatenate([[0], np.cumsum(full)])[offsets - offsets[0]]
    coded = flat.filter(pa.array(full)).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), bounds


def row_of(bounds: np.ndarray) -> np.ndarray:
    """The row each occurrence belongs to."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each bounds[i]:bounds[i+1]; 0 for empty ranges."""
    run = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return run[bounds[1:]] - run[bounds[:-1]]


def hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word."""
    import xxhash
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive hashes; run i starts at i."""
    m = max(0, len(h) - n + 1)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out = mix(out * MIX + h[i:i + m] + np.uint64(i))
    return out


def whole_groups(batches, key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches of a partition that is sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.argmax(k == k[-1]))  # start of the batch's last group
        if held and (cut or held[-1].column(key)[0].as_py() != k[0]):
            if cut:
                held.append(batch.slice(0, cut))
                yield pa.Table.from_batches(held)
                held = [batch.slice(cut)]
            else:
                yield pa.Table.from_batches(held)
                held = [batch]
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with ``rank`` (0, 1, ... in each group, following ``order``, nulls first) and ``size`` (rows of the group).

    Range-sorted and written once, then numbered by the place in the written files: a group that holds
    most rows is spread over many tasks, and only one row per file and group is summed up in a window.
    Rows that tie in ``order`` get ranks in any order. Nulls are a group of their own.
    """
    written = materialize(df.orderBy(*[F.col(c).asc_nulls_first() for c in [*group, *order]]), name)
    at = written.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    per = at.groupBy("_file", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    own = Window.partitionBy(*group)
    # files are named part-<task number>-..., in the order of the sort
    before = own.orderBy(F.regexp_extract("_file", r"^part-(\d+)", 1).cast("long")).rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select(F.col("_file").alias("_f"), *(F.col(c).alias(f"_g{i}") for i, c in enumerate(group)),
                        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_start"), F.sum("_n").over(own).alias("size"))
    same = F.col("_file") == F.col("_f")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return at.join(starts, same).select(*df.columns, (F.col("_start") + F.col("_row")).alias("rank"), "size")
