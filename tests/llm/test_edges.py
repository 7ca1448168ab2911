"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names, for every operator."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import bpe, crf_langid, importance, nn_descent, ppm, probminhash, ss_packing, superkmer, toxicity, tree_dedup
from strata.llm.common import remainder
from strata.llm.queries import vocabulary

LABELS = "doc_id long, toxic int, quality int"


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(9, 1, 0), (1, 0, 1), (2, 0, 1), (2, None, None), (6, 0, 1), (None, 1, 1), (99, 1, 0)], LABELS)


def operators(labels):
    return {
        "toxicity": lambda d: toxicity.score(d, labels, remainder("doc_id", 5) == 0),
        "bpe": lambda d: bpe.round_trip(d, vocabulary("byte_bpe_50k.json")),
        "language": lambda d: crf_langid.predict_language(d, remainder("doc_id", 4) == 2),
        "ppm": lambda d: ppm.score(d, remainder("doc_id", 7) == 2),
        "importance": lambda d: importance.resample(d, d.filter("lang = 'en'"), 0.5),
        "exact": lambda d: tree_dedup.exact_duplicates(d, largest=True),
        "near": lambda d: probminhash.near_duplicates(d),
        "substring": lambda d: superkmer.remove_repeats(d),
    }


@pytest.mark.parametrize("name", list(operators(None)))
def test_one_row_per_document(spark, odd, none, labels, name):
    run = operators(labels)[name]
    assert ids(run(odd)) == ids(odd)
    assert run(none).count() == 0


def test_exact_duplicates(odd):
    got = tree_dedup.exact_duplicates(odd, largest=True).collect()
    of = {(r.doc_id, r.group_size): r for r in got}
    assert of[1, 4].keep_id == 2 and not of[1, 4].kept
    # of the two equal rows with id 2 one stays; nulls and the empty text are one class
    assert sum(r.kept for r in got if r.keep_id == 2 and r.group_size == 4) == 1
    assert {(r.doc_id, r.keep_id) for r in got if r.group_size == 3} == {(3, 4), (4, 4), (None, 4)}
    smallest = tree_dedup.exact_duplicates(odd, largest=False, fan_in=2).collect()
    assert {r.keep_id for r in smallest if r.group_size == 4} == {1}


def test_near_duplicates(odd):
    got = probminhash.near_duplicates(odd).collect()
    assert {r.class_id for r in got if r.class_size == 5} == {1}  # ids 1, 2, 2, null and 11
    assert {r.doc_id: r.class_id for r in got if r.doc_id in (6, 7)} == {6: 6, 7: 6}
    assert {r.doc_id: r.class_id for r in got if r.doc_id in (3, 4, 5, 10)} == {3: 3, 4: 4, 5: 5, 10: 10}


def test_repeats(odd):
    got = superkmer.remove_repeats(odd, carry=["doc_id", "text"]).collect()
    removed = Counter((r.doc_id, r.n_words, r.n_removed) for r in got)
    assert removed[1, 18, 0] == 1 and removed[2, 18, 18] == 2 and removed[None, 18, 18] == 1 and removed[11, 19, 18] == 1
    assert removed[7, 30001, 30000] == 1 and removed[2, 6, 0] == 1 and removed[3, 0, 0] == 1
    assert {r.kept for r in got if r.doc_id == 3} == {None} and {r.kept for r in got if r.doc_id == 11} == {"indeed"}


def test_texts_with_one_id_and_hash(spark):
    """Two texts without id whose 32-bit hashes are equal: only the one that repeats loses words."""
    first = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen 132030"
    other = "a b c d e f g h i j k l m n o p q 14646"
    rows = spark.createDataFrame([(1, first), (None, first), (None, other)], "doc_id long, text string")
    assert len({r.h for r in rows.select(F.hash("text").alias("h")).collect()}) == 1
    got = Counter((r.doc_id, r.n_words, r.n_removed) for r in superkmer.remove_repeats(rows).collect())
    assert got == Counter({(1, 15, 0): 1, (None, 15, 15): 1, (None, 18, 0): 1})


def test_spans_of_copies_do_not_grow(spark):
    """However many equal rows without id there are, they have one list of spans."""
    text = " ".join(f"w{i}" for i in range(400))
    most = []
    for n in (20, 2000):
        rows = spark.createDataFrame([(1, text), *[(None, text)] * n], "doc_id long, text string").repartition(8)
        spans = superkmer.repeated_spans(rows)
        most.append(spans.distinct().count())
        got = Counter((r.doc_id, r.n_removed) for r in superkmer.remove_repeats(rows).collect())
        assert got == Counter({(None, 400): n, (1, 0): 1})
    assert most[1] <= 8 * most[0] and most[1] < 400


def test_packing(odd, none):
    path = vocabulary("word_bpe_49k.json")
    got = ss_packing.pack_documents(odd, path).collect()
    assert Counter(r.doc_id for r in got if r.piece == 0) == ids(odd)
    assert {r.length for r in got if r.doc_id in (3, 4, 5)} == {1}
    assert sum(r.length == 4096 for r in got) > 10
    assert ss_packing.pack_documents(none, path).count() == 0


def test_language_without_letters(odd, none):
    got = {r.doc_id: r for r in crf_langid.predict_language(odd, remainder("doc_id", 4) == 2).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (3, 4, 5, 8))
    assert got[6].lang_pred == "fr"
    unlearned = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in crf_langid.predict_language(unlearned, F.lit(False)).collect()} == {"und"}


def test_toxicity_without_labels(spark, odd):
    got = toxicity.score(odd, spark.createDataFrame([], LABELS), F.lit(False)).collect()
    assert {(r.score, r.predicted) for r in got} == {(0.0, 0)}


def test_ppm_without_training(odd):
    got = {r.doc_id: r for r in ppm.score(odd, F.lit(True)).collect()}
    assert got[3].train_tokens == 0 and got[3].n_known == 0 and abs(got[3].score + 2.408239965) < 1e-6  # 1 of 256
    assert got[3].base_score == 0.0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1), (7, [nan, 1.0], 1),
            (8, [inf, 1.0], 1), (9, [1.0, 0.0], None), (10, [1.0, 0.01], 1), (11, [0.0, 1.0], 1), (12, [1.0], 1), (12, [1.0], 1), (None, [1.0, 0.0], 1), (13, [], 1)]
    kind = "vec_id long, embedding array<float>, label int, node string, unit int, part int"
    got = nn_descent.near_vectors(spark.createDataFrame([(*r, "n", 1, 2) for r in rows], kind)).collect()
    links = {(r.vec_id, r.n_links, r.component_id) for r in got}
    assert {(1, 3, 1), (2, 3, 1), (10, 3, 1), (None, 3, 1), (3, 0, 3), (11, 0, 11), (12, 1, 12)} <= links
    assert all((i, 0, i) in links for i in (4, 5, 6, 7, 8, 9, 13)) and len(got) == len(rows)
    assert nn_descent.near_vectors(spark.createDataFrame([], kind)).count() == 0


def test_pipeline_stages(spark, odd, none, labels, workdir):
    labels.write.parquet(f"{workdir}/labels.parquet")
    for docs in (odd, none):
        n = docs.count()
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = corpus_pipeline.materialize(stage(spark, docs, workdir), name)
            if i + 1 < len(corpus_pipeline.STAGES):
                assert docs.columns == odd.columns and docs.count() <= n
                n = docs.count()
        # toxicity keeps at most the 16 rows; one row a class is left, and each is packed
        assert docs.filter("piece = 0").count() == n
    assert n == 0


def test_word_hashes():
    """Equal words hash alike wherever they lie; words that differ in a byte, or in length, don't."""
    import pyarrow as pa
    words = ["a", "b", "ab", "é", "12345678", "123456789", "1234567", "x" * 64, "x" * 65, "x" * 66, "y" * 200, "x" * 63 + "y", "\x00", "\x00\x00", "a\x00"]
    h = superkmer.word_hashes(pa.array(words))
    assert len(set(h.tolist())) == len(words)
    assert superkmer.word_hashes(pa.array(["pad", *words[::-1]]).slice(1)).tolist() == h.tolist()[::-1]
    assert len(superkmer.word_hashes(pa.array([], pa.string()))) == 0
    many = pa.array([f"w{i}" for i in range(200_000)])
    assert len(set(superkmer.word_hashes(many).tolist())) == 200_000


def test_packing_looks_words_up_for_much_text_at_once():
    import pyarrow as pa

    from strata.llm.common import slices
    texts = pa.RecordBatch.from_pydict({"text": ["word " * 200_000] * 12})  # 12 MB
    assert len(list(slices([texts], most=ss_packing.AT_ONCE))) == 1 < len(list(slices([texts])))
