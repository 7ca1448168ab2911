"""Samples stay within their bounds when ids repeat; recall is measured or null."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import crf_langid, nn_descent, toxicity


def fitted(monkeypatch):
    seen = []
    fit = crf_langid.Model.fit

    def recorded(self, texts, label, **kw):
        seen.append(texts.to_pylist())
        return fit(self, texts, label, **kw)
    monkeypatch.setattr(crf_langid.Model, "fit", recorded)
    return seen


@pytest.mark.parametrize("doc_id", [7, None])
def test_language_sample_of_one_repeated_id(spark, monkeypatch, doc_id):
    seen = fitted(monkeypatch)
    rows = [(doc_id, f"alpha beta w{i} gamma", "en") for i in range(5000)] + [(100 + i, f"uno dos t{i} tres", "es") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = crf_langid.predict_language(df, F.lit(False), fit_rows=200).collect()
    assert len(seen[0]) == 150 and len(set(seen[0])) == 150  # 100 of one language, the 50 there are of the other
    assert len(got) == 5050 and {r.lang_pred for r in got if r.doc_id in (7, None)} == {"en"}


def test_language_sample_of_equal_rows_and_long_texts(spark, monkeypatch):
    seen = fitted(monkeypatch)
    equal = spark.createDataFrame([(7, "alpha beta gamma", "en")] * 3000 + [(8, "uno dos tres", "es")] * 10, "doc_id long, text string, lang string")
    crf_langid.predict_language(equal, F.lit(False)).collect()
    assert sorted(seen[0]) == ["alpha beta gamma", "uno dos tres"]
    monkeypatch.setattr(crf_langid, "FIT_BYTES", 20_000)
    rows = [(i, f"long{i} " * 1000, "en") for i in range(40)] + [(100 + i, f"corto{i}", "es") for i in range(40)]
    crf_langid.predict_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(False)).collect()
    long = [x for x in seen[1] if x.startswith("long")]
    assert 1 <= len(long) <= 2 and all(x.count(" ") == 1000 for x in long) and len(seen[1]) - len(long) == 40  # whole texts, fewer rows


def test_toxicity_sample_of_one_repeated_id(spark, monkeypatch):
    counts = []
    learn = toxicity.learn

    def recorded(sample, model):
        counts.append((sample.count(), sample.distinct().count()))
        return learn(sample, model)
    monkeypatch.setattr(toxicity, "learn", recorded)
    rows = [(7, f"you are a plain idiot w{i}") for i in range(3000)] + [(i, f"a fine day number {i}") for i in range(100, 200)]
    labels = spark.createDataFrame([(7, 1), *[(i, 0) for i in range(100, 200)]], "doc_id long, toxic int")
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), labels, F.lit(False), fit_rows=500)
    assert got.count() == 3100 and counts == [(500, 500)]


def vectors(spark, n, pairs, seed=3):
    """``n`` random vectors, of which the first 2 * ``pairs`` are pairs of cosine 0.95."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(pairs):
        aside = x[2 * i + 1] - (x[2 * i + 1] @ x[2 * i]) * x[2 * i]
        x[2 * i + 1] = 0.95 * x[2 * i] + np.sqrt(1 - 0.95 ** 2) * aside / np.linalg.norm(aside)
    return spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").withColumn("label", F.lit(1))


def test_rare_links_are_measured(spark, monkeypatch):
    """Three pairs among 1,500 vectors: a small random sample meets none, the nodes near the threshold do."""
    monkeypatch.setattr(nn_descent, "AUDIT", 16)
    got = nn_descent.near_vectors(vectors(spark, 1500, 3)).collect()
    assert {r.audit_recall for r in got} == {1.0}
    assert {r.vec_id: r.n_links for r in got if r.n_links} == {i: 1 for i in range(6)}


def test_no_link_means_no_recall(spark):
    got = nn_descent.near_vectors(vectors(spark, 300, 0)).collect()
    assert {r.audit_recall for r in got} == {None} and all(r.n_links == 0 for r in got)
