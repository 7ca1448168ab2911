"""Importance weights, Gumbel keys and the choice, restated; held-out labels."""

import math
import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from strata.llm import importance, queries

MASK = 2 ** 64 - 1


def mix(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def cells(text):
    # letters are put in lower case one by one, words end at ASCII white space
    h = [xxhash.xxh3_64_intdigest(w) for w in re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if len(c.lower()) == 1 else c for c in text or ""))]
    return [mix(x) % importance.CELLS for x in h] + [mix((a * 0x9E3779B97F4A7C15 + b) & MASK) % importance.CELLS for a, b in zip(h, h[1:])]


def weights(texts, of_target):
    raw, own = Counter(), Counter()
    for t, good in zip(texts, of_target, strict=True):
        raw.update(cells(t))
        own.update(cells(t) if good else [])
    n, q = sum(raw.values()), sum(own.values())
    back = min(importance.CELLS, 0.1 * q)
    ratio = lambda c: math.log((own[c] + back * raw[c] / n) / (q + back) / (raw[c] / n)) if q else 0.0
    return [sum(map(ratio, cells(t))) for t in texts]


def test_weights_restated(spark):
    texts = [r.text for r in queries.documents(spark, "/root/testdata/sf0.001").collect()] + ["", None, "One two ONE", "one two one", "ΣΑΣ é"]
    good = [i % 3 == 0 for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(zip(texts, good, strict=True))], "doc_id long, text string, good boolean")
    want = weights(texts, good)
    for target in (F.col("good"), df.filter("good")):
        rows = importance.resample(df, target, 0.25).collect()
        assert all(math.isclose(r.log_weight, want[r.doc_id], rel_tol=1e-9, abs_tol=1e-9) for r in rows)
        # the largest keys are chosen
        keys = sorted((r.gumbel_key for r in rows), reverse=True)
        k = round(0.25 * len(texts))
        assert sorted((r.gumbel_key for r in rows if r.selected), reverse=True) == keys[:k]


def test_noise_is_gumbel(spark):
    """The noise of equal weights follows exp(-exp(-x)), and is the same each time."""
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"))
    got = [sorted((r.doc_id, r.gumbel_key) for r in importance.resample(df, F.lit(False), 0.1).collect()) for _ in range(2)]
    assert got[0] == got[1]
    x = np.sort([key for _, key in got[0]])
    assert np.abs(np.exp(-np.exp(-x)) - (np.arange(len(x)) + 0.5) / len(x)).max() < 0.015


def test_chosen_ids(spark):
    ids = spark.createDataFrame([(i % 700 if i % 9 else None,) for i in range(5000)], "doc_id long")
    got = [r.doc_id for r in importance.chosen_ids(ids, 50).collect()]
    assert len(got) == len(set(got)) == 50 and None not in got
    lowest = [r.doc_id for r in ids.filter("doc_id is not null").distinct().orderBy(F.xxhash64("doc_id")).limit(50).collect()]
    assert got == lowest


def test_held_out_labels(spark):
    """Good texts that were not learned from weigh more than bad ones."""
    sf = "/root/testdata/sf0.1"
    quality = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    got = queries.op6_importance(spark, sf).join(quality, "doc_id").filter("held_out").select("mean_log_weight", "quality").collect()
    good, bad = ([r[0] for r in got if r[1] == k] for k in (1, 0))
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) >= 0.75


def test_texts_are_not_shuffled(spark):
    """The target's ids go to the texts; no exchange carries a text."""
    docs = queries.documents(spark, "/root/testdata/sf0.001")
    good = importance.chosen_ids(docs.select("doc_id")).withColumn("good", F.lit(True))
    joined = docs.join(F.broadcast(good), "doc_id", "left").select("text", "good")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert any("Broadcast" in x for x in exchanges) and not any("text" in x for x in exchanges)
