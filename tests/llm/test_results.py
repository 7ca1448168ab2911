"""Operators against plain restatements on small inputs."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import bpe, components, crf_langid, importance, nn_descent, ppm, probminhash, queries, ss_packing, superkmer, toxicity
from strata.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"
ODD_TEXTS = ["", " ", "a  b", "x<|endoftext|> y <|ENDOFTEXT|> z<|endoftext|>.", "don't stop's it's'. we'll,\n\n now", "tab\there b", "é　ñ 123 4a ΑΣ ΣΑΣ. İstanbul İ! ǅ",
             "क़ ख़.", "ÉCOLE école École. á.", "a\x1cb \x1f c", "日本語 テキスト。", "😀😀 ok!? \"q\") x]}", "ﬁ ﬂ Å Å Ω", "a" * 300, " lead", "trail ", "\n", "a\x85b"]


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text for r in queries.documents(spark, SF).collect()] + ODD_TEXTS


def reference(name):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary(name))


def test_bpe_equals_the_library(texts):
    codec, ref = bpe.Codec(vocabulary("byte_bpe_50k.json")), reference("byte_bpe_50k.json")
    want = ref.encode_batch(texts, add_special_tokens=False)
    for (ids, back), w, text in zip(codec.encode_all(pa.array(texts)), want, texts, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == w.ids, text[:80]
        assert back.decode() == ref.decode(w.ids, skip_special_tokens=False)


def test_bpe_frames(spark):
    path = vocabulary("byte_bpe_50k.json")
    docs = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string")
    back = bpe.decode(bpe.encode(docs, path), path)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == list(enumerate(ODD_TEXTS))
    lost = spark.createDataFrame([(1, [31373, None, 99_999_999, 995]), (2, None)], "doc_id long, ids array<int>")
    assert sorted((r.doc_id, r.text) for r in bpe.decode(lost, path).collect()) == [(1, "hello world"), (2, "")]


def test_packing_words_equal_the_library(texts):
    from strata.llm.common import word_table
    own, ref = ss_packing.WordIds(vocabulary("word_bpe_49k.json")), reference("word_bpe_49k.json")
    words, at, bounds = word_table(pa.array(texts))
    ids, at = own.of(words.to_pylist()), at.tolist()
    for i, w in enumerate(ref.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(b"".join(ids[k] for k in at[bounds[i]:bounds[i + 1]]), "<u4").tolist() == w.ids, texts[i][:80]


def test_packing_places(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts + [" ".join(texts) * 3])), "doc_id long, text string")
    packed = ss_packing.pack(ss_packing.tokenize(docs, vocabulary("word_bpe_49k.json"), with_ids=True), shard_rows=60)
    rows = packed.collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(by) <= 1.05 * -(-sum(r.length for r in rows) // 4096) + 4
    doc = sorted((r.piece, r.start, r.ids) for r in rows if r.id == len(texts))
    assert [len(x) for *_, x in doc[:-1]] == [4096] * (len(doc) - 1) and doc[-1][2][-1] == 1
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    whole = {r.sequence_id: r.ids for r in ss_packing.sequences(packed).collect()}
    assert all(whole[r.sequence_id][r.offset:r.offset + r.length] == r.ids for r in rows)


def test_sum_of_squares_rule():
    """Each choice is one that makes the sum of squares smallest."""
    rng = random.Random(1)
    sizes = [rng.randint(1, 20) for _ in range(300)]
    where, offset = ss_packing.sum_of_squares(np.array(sizes), 20)
    gap: dict[int, int] = {}
    for s, b, o in zip(sizes, where.tolist(), offset.tolist(), strict=True):
        cost = lambda g: sum(n * n for x, n in collections.Counter(g.values()).items() if x)
        options = [cost({**gap, k: v - s}) for k, v in gap.items() if v >= s] + [cost({**gap, -1: 20 - s})]
        assert o == 20 - gap.get(b, 20)
        gap[b] = gap.get(b, 20) - s
        assert cost(gap) == min(options)


WORDS = st.lists(st.sampled_from("a b c d".split()), max_size=40).map(" ".join)


@settings(max_examples=6, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=25))
def test_repeats_against_plain_python(spark, docs):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_removed, r.kept) for r in superkmer.remove_repeats(df, width=4, m=2).collect()}
    first: dict[tuple, int] = {}
    for i, t in enumerate(docs):
        w = t.split()
        for s in range(len(w) - 3):
            first.setdefault(tuple(w[s:s + 4]), i)
    for i, t in enumerate(docs):
        w = t.split()
        gone = {j for s in range(len(w) - 3) if first[tuple(w[s:s + 4])] < i for j in range(s, s + 4)}
        assert got[i][0] == len(gone)
        if gone:
            assert got[i][1] == " ".join(x for j, x in enumerate(w) if j not in gone)


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(3)
    docs = []
    for _ in range(60):
        base = [f"v{rng.randrange(4000)}" for _ in range(rng.randint(30, 300))]
        docs.append(base)
        for _ in range(rng.choice((0, 0, 1, 6))):
            other = list(base)
            for _ in range(rng.randint(1, 8)):
                other[rng.randrange(len(other))] = "zz"
            docs.append(other)
    rng.shuffle(docs)
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in probminhash.near_duplicates(df).collect()}
    bags = [collections.Counter(zip(*(d[k:] for k in range(5)), strict=False)) for d in docs]
    top = list(range(len(docs)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    for a, b in itertools.combinations(range(len(docs)), 2):
        x, y = bags[a], bags[b]
        # probability Jaccard by its definition
        sim = sum(1 / sum(max(x[t] / x[s], y[t] / y[s]) for t in x.keys() | y.keys()) for s in x.keys() & y.keys())
        if sim >= 0.8:
            p, q = find(a), find(b)
            top[max(p, q)] = min(p, q)
    assert got == {i: find(i) for i in range(len(docs))}


def test_probability_jaccard_of_weighted_sets():
    a, b = {1: 2, 2: 1, 5: 4}, {1: 1, 2: 3, 7: 2}
    want = sum(1 / sum(max(a.get(t, 0) / a[s], b.get(t, 0) / b[s]) for t in {*a, *b}) for s in a.keys() & b.keys())
    pack = lambda d: (np.array(sorted(d), np.uint64), np.array([d[k] for k in sorted(d)]))
    assert math.isclose(probminhash.probability_jaccard(pack(a), pack(b)), want)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2 ** 50, 300, dtype=np.uint64)
    y = np.concatenate([x[:260], rng.integers(0, 2 ** 50, 40, dtype=np.uint64)])
    sig = probminhash.signatures(np.repeat([0, 1], 300), np.concatenate([x, y]), np.ones(600), 2, 1024)
    assert abs((sig[0] == sig[1]).mean() - 260 / 340) < 0.05


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, edges):
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    top = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in edges:
        for a, b in edges:
            if a != b:
                top[a] = top[b] = min(top[a], top[b])
    assert got == top


def test_ppm_against_plain_python(spark):
    rows = [(r.doc_id, r.text) for r in queries.documents(spark, SF).filter("doc_id < 60").collect()]
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in ppm.score(df, F.crc32(F.col("doc_id").cast("string")) % 7 == 2).collect()}
    low = lambda t: re.sub(rb"[A-Z]", lambda m: m[0].lower(), t.encode())
    tokens = lambda t: [w for w in re.split(rb"[ \t-\r]+", low(t)) if w] + [None]
    count = collections.Counter(w for i, t in rows if i not in held for w in tokens(t))
    total, kinds = sum(count.values()), len(count)
    after = [collections.defaultdict(collections.Counter) for _ in range(ppm.ORDER + 1)]
    lay = lambda t: b"\xff" * ppm.ORDER + low(t) + b"\xff"
    for i, t in rows:
        if i not in held:
            b = lay(t)
            for j, k in itertools.product(range(ppm.ORDER, len(b)), range(ppm.ORDER + 1)):
                after[k][b[j - k:j]][b[j]] += 1

    def log_p(b, j):
        out, gone = 0.0, set()
        for k in range(ppm.ORDER, -1, -1):
            seen = {s: n for s, n in after[k].get(b[j - k:j], {}).items()}
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in gone}
            weight = sum(left.values()) + len(left)
            if b[j] in left:
                return out + math.log10(left[b[j]] / weight)
            out += math.log10(len(left) / weight) if left else 0
            gone |= set(seen)
        return out - math.log10(256 - len(gone))
    for i, t in rows:
        r = got[i]
        assert (r.held_out, r.train_tokens, r.n_tokens) == (i in held, total, len(tokens(t)))
        assert r.n_known == sum(count[w] > 0 for w in tokens(t))
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in tokens(t)), rel_tol=1e-9)
        if i % 6 == 0:
            b = lay(t)
            assert math.isclose(r.score, sum(log_p(b, j) for j in range(ppm.ORDER, len(b))), rel_tol=1e-5)


def test_ppm_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    data = pa.array(["".join(rng.choice(list("abc "), 400)) for _ in range(3)])
    codes = ppm.byte_grams(data)[0]
    grams = []
    for k in range(ppm.ORDER + 1):
        g, n = np.unique(codes & ppm.mask(k + 1), return_counts=True)
        grams.append((g, n) if k < 3 else (g[n > 1], n[n > 1]))  # a pruned trie too
    trie = ppm.Trie(grams)
    for context in (codes[50], codes[700], np.uint64(0x7A7A7A7A7A7A)):
        every = (context << np.uint64(8)) & ppm.mask(ppm.ORDER + 1) | np.arange(256, dtype=np.uint64)
        assert math.isclose(np.exp(trie.log_probability(every)).sum(), 1, rel_tol=1e-9)


def test_ppm_scores_do_not_depend_on_what_is_sent(spark):
    """Every context counts, also those that do not fit the table that tasks receive."""
    docs = queries.documents(spark, SF)
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    want = {r.doc_id: r.score for r in ppm.score(docs, held).collect()}
    for few in (0, 500):
        got = {r.doc_id: r.score for r in ppm.score(docs, held, "doc_id", "text", few).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], rel_tol=1e-9) for i in want)


def test_vectors_against_all_pairs(spark):
    """Isolated pairs, and a dense group far larger than a neighbour list."""
    rng = np.random.default_rng(5)
    points = [rng.standard_normal(32) for _ in range(300)]
    points += [p + 0.05 * rng.standard_normal(32) for p in points[:40]]
    centre = rng.standard_normal(32)
    points += [centre + 0.22 * rng.standard_normal(32) for _ in range(120)] + [points[0]] * 3
    label = [int(i % 5 == 0) for i in range(len(points))]
    df = spark.createDataFrame([(i, [float(x) for x in p], c) for i, (p, c) in enumerate(zip(points, label, strict=True))], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in nn_descent.near_vectors(df, k=6).collect()}
    u = np.array(points)
    u /= np.linalg.norm(u, axis=1)[:, None]
    near = (u @ u.T >= 0.93) & (np.array(label)[:, None] == np.array(label))
    np.fill_diagonal(near, False)
    found, there = sum(r.n_links for r in got.values()), int(near.sum())
    assert all(got[i].n_links <= near[i].sum() for i in got) and found >= 0.98 * there


@pytest.mark.parametrize(("tries", "recall"), [(3, 0.98), (1, 2.0)])
def test_isolated_pairs_beside_a_hot_group(spark, monkeypatch, tries, recall):
    """A hot group's links don't hide lost pairs: the first graph, of tiny groups, finds too few. Past the last try all pairs are compared."""
    for name, value in {"GROUP": 4, "TABLES": 2, "TRIES": tries, "RECALL": recall}.items():
        monkeypatch.setattr(nn_descent, name, value)
    rng = np.random.default_rng(7)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    one = unit(rng.standard_normal((500, 64)))
    aside = rng.standard_normal((500, 64))
    aside = unit(aside - (aside * one).sum(axis=1, keepdims=True) * one)
    hot = unit(unit(rng.standard_normal(64)) + 0.02 * rng.standard_normal((300, 64)))
    u = np.concatenate([one, 0.935 * one + np.sqrt(1 - 0.935 ** 2) * aside, hot])
    df = spark.createDataFrame([(i, x) for i, x in enumerate(u.tolist())], "vec_id long, embedding array<double>").withColumn("label", F.lit(1))
    got = {r.vec_id: r for r in nn_descent.near_vectors(df).collect()}
    near = u @ u.T >= 0.93
    np.fill_diagonal(near, False)
    there = near[:1000].sum()
    assert there >= 1000 and sum(got[i].n_links for i in range(1000)) >= 0.97 * there
    if tries == 1:
        assert all(r.n_links == near[i].sum() for i, r in got.items()) and {r.audit_recall for r in got.values()} == {1.0}
        assert all(got[i].component_id == got[500 + i].component_id == i for i in range(500)) and len({got[i].component_id for i in range(1000, 1300)}) == 1


def test_language_accuracy(spark):
    got = queries.op4_language(spark, SF).filter("held_out").join(queries.documents(spark, SF), "doc_id").collect()
    assert len(got) > 30 and np.mean([r.lang == r.lang_pred for r in got]) >= 0.95


def test_every_language_is_learned(spark):
    """More languages than 64, each with words of its own."""
    rng = random.Random(4)
    words = [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)] for _ in range(80)]
    rows = [(j * 80 + i, " ".join(rng.choices(words[i], k=15)), f"l{i:02}") for i in range(80) for j in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in crf_langid.predict_language(df, F.col("doc_id") < 80).collect()}
    assert np.mean([got[i] == f"l{i:02}" for i in range(80)]) >= 0.95


def test_language_without_white_space(spark):
    """Texts that are one run of letters, alike at both ends, and scripts that change within a run."""
    rng = random.Random(6)
    signs = {"l0": "".join(map(chr, range(0x4E00, 0x4E40))), "l1": "".join(map(chr, range(0x4E40, 0x4E80)))}
    text = lambda lang: "一二三丁七万丈三上下丌不与丐丑专" + "".join(rng.choices(signs[lang], k=200)) + "且丕世丗"
    rows = [(i, text(lang), lang) for i in range(80) for lang in [f"l{i % 2}"]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in crf_langid.predict_language(df, F.col("doc_id") < 40).collect()}
    assert all(got[i] == f"l{i % 2}" for i in range(40))
    assert crf_langid.pieces("日本語text") == ["日本語", "text"] and crf_langid.pieces("(word),") == ["(word),"]
    assert "".join(crf_langid.pieces("a" * 50)) == "a" * 50
    hindi = "अंतरराष्ट्रीयकरणकेलिए"
    assert "".join(crf_langid.pieces(hindi)) == hindi and len(crf_langid.pieces(hindi)) == 2


def test_language_of_words_by_forward_backward():
    """Marginals of a small chain equal those summed over all label sequences."""
    model = crf_langid.Model(["a", "b"], np.ones((crf_langid.LEXICON, 2)))
    model.moves = np.array([[0.7, -0.2], [0.1, 0.4]], np.float32)
    score = np.random.default_rng(1).standard_normal((5, 2)).astype(np.float32)
    want = np.zeros((5, 2))
    for y in itertools.product((0, 1), repeat=5):
        p = np.exp(sum(score[t, y[t]] for t in range(5)) + sum(model.moves[y[t], y[t + 1]] for t in range(4)))
        for t in range(5):
            want[t, y[t]] += p
    want /= want.sum(axis=1, keepdims=True)
    assert np.allclose(model.marginals(score, np.array([5])), want, atol=1e-5)


def test_deobfuscation():
    words = "the stupid idiot said a moron lost his trash on the worthless scum list and the loser clown is pathetic".split()
    model = np.zeros(toxicity.CLASSES ** 3)
    for w in words * 50:
        k = [0, 0, *(toxicity.CLASS[c] for c in w), 0, 0]
        for a, b, c in zip(k, k[1:], k[2:], strict=False):
            model[(a * toxicity.CLASSES + b) * toxicity.CLASSES + c] += 1
    reader = toxicity.Reader(toxicity.log_model(model))
    plain, at, bounds, spelled = reader.words(pa.array(["you 1d10t and m0r0n, s.c.u.m st*u*pid", "iiidiooot l o s e r", "clean text, with 2023 numbers!"]))
    seen = [[plain[w] for w in at[s:e].tolist()] for s, e in itertools.pairwise(bounds)]
    assert seen[0] == ["you", "idiot", "and", "moron", "scum", "stupid"]
    assert seen[1][0] == "idiot" and spelled == [(1, "loser")]
    assert seen[2] == ["clean", "text", "with", "2023", "numbers"]


@pytest.mark.parametrize(("text", "word"), [
    ("what a l o s e r", "loser"), ("you are a m o r o n", "moron"), ("y o u i d i o t", "idiot"), ("such s c u m.", "scum"), ("how st up id", "stupid"),
    ("l o s e r", "loser"), ("a total m o r o n, a c l o w n!", "clown")])
def test_spaced_words_beside_others(spaced_reader, text, word):
    assert word in [x for _, x in spaced_reader.words(pa.array([text]))[3]]


@pytest.fixture(scope="module")
def spaced_reader(spark):
    """The character model of the documents at sf0.01."""
    docs = queries.documents(spark, "/root/testdata/sf0.01")
    return toxicity.Reader(toxicity.log_model(toxicity.trigram_counts(docs.filter("text is not null"))))


def test_a_spelled_word_is_not_cut(spaced_reader):
    assert "loser" not in [x for _, x in spaced_reader.words(pa.array(["much c l o s e r now"]))[3]]


def test_rows_of_one_short_word(spaced_reader):
    """The work grows with the row's length only."""
    assert len(spaced_reader.words(pa.array(["of " * 3000 + "l o s e r"]))[3]) < 100 * 3000


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.op1_toxicity(spark, sf).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) >= 0.9
    # labels are noisy at this size: the ones missed hold no word that other toxic texts share
    assert sum(r.predicted for r in got if r.toxic == 0) <= 0.05 * len(got)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.sampled_from([0.0, 1.0, 2.5, -3.0, 1e-9]), max_size=30), st.integers(0, 31))
def test_top_k(spark, keys, k):
    df = spark.createDataFrame([(x, float(i)) for i, x in enumerate(keys)], "key double, tie double")
    got = {r.tie for r in importance.top_k(df, k).filter("selected").collect()}
    want = sorted(range(len(keys)), key=lambda i: (-keys[i], i))[:k]
    assert got == {float(i) for i in want}


def test_importance_prefers_the_target(spark):
    good = [(i, f"alpha beta gamma{i % 5} delta") for i in range(100)]
    junk = [(100 + i, f"xx{i % 7} yy zz") for i in range(100)]
    raw = spark.createDataFrame(good + junk, "doc_id long, text string")
    got = importance.resample(raw, raw.filter("doc_id < 50"), 0.5).collect()
    assert sum(r.selected for r in got) == 100
    assert sum(r.selected for r in got if r.doc_id < 100) >= 97
    assert {r.doc_id for r in got if r.selected} == {r.doc_id for r in importance.resample(raw, raw.filter("doc_id < 50"), 0.5).collect() if r.selected}
