"""Data selection by importance resampling.

Two bags of hashed n-grams (words and pairs of neighbouring words, ``CELLS`` cells) are
counted: over the target texts and over all raw texts. Each defines a generative model in
which n-grams are drawn independently; a text's log importance weight is the sum of log
target over raw probability of its n-grams. Adding Gumbel noise to the weights and taking
the k largest samples k texts without replacement in proportion to their weights. The
noise comes from a hash of the id, so a text always has the same noise.

The k-th largest is found by counting keys in ever finer ranges (``STEPS`` counts a round
reach the driver), not by sorting all rows to one place.

Defined results: a null or empty text has weight 0; with ties at the border the smaller
hash of (id, row) wins, so exactly k rows are taken; rows repeated are separate texts;
without target texts all weights are 0 and the choice is uniform.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import MIX, hashes, mix, row_of, slices, sums, word_table
from strata.session import materialize

CELLS = 1 << 16
STEPS = 1024
#: Ids of target texts that ``chosen_ids`` names at most (with the lowest hashes).
TARGET_IDS = 100_000


def ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(cells, bounds) of the hashed words and word pairs of each text, in lower case."""
    words, at, bounds = word_table(pc.utf8_lower(texts))
    h = hashes(words)[at]
    row = row_of(bounds)
    pair = np.flatnonzero(row[1:] == row[:-1])
    cell = np.concatenate([mix(h), mix(h[pair] * MIX + h[pair + 1])]) % np.uint64(CELLS)
    owner = np.concatenate([row, row[pair]])
    order = np.argsort(owner, kind="stable")
    return cell[order].astype(np.int64), np.searchsorted(owner[order], np.arange(len(texts) + 1))


def cell_counts(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts by cell over whole texts (text, target: whether it is one of the target's): of the target's, of all. One scan."""
    def run(batches):
        own, all_ = np.zeros(CELLS, np.int64), np.zeros(CELLS, np.int64)
        for b in slices(batches):
            cell, bounds = ngrams(b.column("text"))
            all_ += np.bincount(cell, minlength=CELLS)
            of_target = np.repeat(b.column("target").to_numpy(zero_copy_only=False).astype(bool), np.diff(bounds))
            own += np.bincount(cell[of_target], minlength=CELLS)
        at = np.flatnonzero(all_)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(own[at]), pa.array(all_[at])], ["cell", "own", "n"])
    rows = texts.select("text", "target").mapInArrow(run, "cell int, own long, n long").groupBy("cell").agg(F.sum("own").alias("own"), F.sum("n").alias("n")).toArrow()
    out = np.zeros((2, CELLS))
    out[:, rows.column("cell").to_numpy()] = rows.column("own").to_numpy(), rows.column("n").to_numpy()
    return out[0], out[1]


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log p(cell | target) - log p(cell | raw); a cell without raw n-grams, or no target at all, says nothing."""
    if not target.sum():
        return np.zeros(CELLS)
    p, q = raw / max(raw.sum(), 1), target.sum()
    # the target's counts are backed by pseudo-counts spread as the raw text is: one a cell, a tenth of the target at most
    back, share = min(CELLS, 0.1 * q), np.where(raw > 0, p, 1)
    return np.where(raw > 0, np.log((target + back * share) / (q + back) / share), 0.0)


def kth_largest(keys: DataFrame, k: int) -> tuple[float, int]:
    """(value, how many are larger) of the k-th largest of the column ``key``; 1 <= k <= rows."""
    a, b = keys.agg(F.min("key"), F.max("key")).first()
    larger = 0
    while a < b:
        step = F.least(F.floor((F.col("key") - F.lit(a)) / F.lit((b - a) / STEPS)), F.lit(STEPS - 1))
        counted = keys.filter(F.col("key").between(a, b)).groupBy(step.alias("step")).agg(
            F.count("*").alias("n"), F.min("key").alias("a"), F.max("key").alias("b")).orderBy(F.desc("step")).collect()
        for r in counted:
            a, b = r["a"], r["b"]
            if larger + r["n"] >= k:
                break
            larger += r["n"]
        if larger + r["n"] == k:
            return a, k - keys.filter(F.col("key").between(a, b) & (F.col("key") == F.lit(a))).count()
    return a, larger


def top_k(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` (key: double; tie: double, small goes first) with selected: whether the row is among the k largest keys."""
    k = min(k, rows.count())
    if k <= 0:
        return rows.withColumn("selected", F.lit(False))
    value, larger = kth_largest(rows.select("key"), k)
    border = -kth_largest(rows.filter(F.col("key") == F.lit(value)).select((-F.col("tie")).alias("key")), k - larger)[0]
    return rows.withColumn("selected", (F.col("key") > F.lit(value)) | ((F.col("key") == F.lit(value)) & (F.col("tie") <= F.lit(border))))


def chosen_ids(ids: DataFrame, most: int = TARGET_IDS) -> DataFrame:
    """Distinct ids (one column, not null), those with the ``most`` lowest hashes: small enough to be sent to every task."""
    c = ids.columns[0]
    return ids.filter(F.col(c).isNotNull()).distinct().orderBy(F.xxhash64(c), c).limit(most)


def resample(raw: DataFrame, target: DataFrame | Column, fraction: float, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """One row per row of ``raw``: id, log_weight, mean_log_weight, gumbel_key, selected, and ``more`` columns.

    ``fraction`` of all rows (rounded) is selected, to be like the texts of ``target``: a frame, or a condition on ``raw``'s rows
    (which are then read once for both models)."""
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    src = raw.select(F.col(id_col).alias("id"), text, *more)
    names = [c for c in src.columns if c != "text"]
    if isinstance(target, DataFrame):
        own, _ = cell_counts(target.select(text, F.lit(True).alias("target")))
        _, all_ = cell_counts(src.select("text", F.lit(False).alias("target")))
    else:
        own, all_ = cell_counts(raw.select(text, F.coalesce(target, F.lit(False)).alias("target")))
    shared = raw.sparkSession.sparkContext.broadcast(log_ratio(own, all_))

    def run(batches):
        for b in slices(batches):
            cell, bounds = ngrams(b.column("text"))
            w = sums(shared.value[cell], bounds)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(w), pa.array(w / np.maximum(np.diff(bounds), 1))], [*names, "log_weight", "mean_log_weight"])
    kind = ", ".join(f"{c} {src.schema[c].dataType.simpleString()}" for c in names)
    weighed = materialize(src.select(*names, "text").mapInArrow(run, kind + ", log_weight double, mean_log_weight double")
                          .withColumn("row", F.monotonically_increasing_id()), "weights")
    bits = lambda *c: F.pmod(F.xxhash64(*c), F.lit(2 ** 52)).cast("double")
    noise = -F.log(-F.log((bits("id", "row") + 0.5) / 2.0 ** 52))
    keyed = weighed.withColumn("key", F.col("log_weight") + noise).withColumn("tie", bits("row", "id"))
    chosen = top_k(keyed, round(fraction * weighed.count()))
    return chosen.drop("tie", "row").withColumnRenamed("key", "gumbel_key").withColumnRenamed("id", id_col)
