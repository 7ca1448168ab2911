"""SentencePiece encoding and decoding against the library, and the backtracking against plain joining."""

import hashlib
import random

import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import piece_bpe, queries
from strata.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "a  b", "x </s> <s> <unk> <0x0A>z", "don't\n\n now", "tab\there b", "é　ñ 123 ΑΣ. İstanbul ǅ", "क़ ख़.", "日本語 テキスト。", "😀😀 ok!?", "a" * 300,
       "          x            y                        z", " lead", "trail ", "\n", "a\n", "\nb", "a \n b", "a\x85b\x00c", "a▁b ▁ ▁▁c", "▁", "ab" * 5000, "  \n  "]


@pytest.fixture(scope="module")
def own():
    return piece_bpe.Pieces(vocabulary("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))


def equal(own, library, texts):
    for text, (ids, n, back), want in zip(texts, own.encode_all(pa.array(texts)), library.encode(texts, add_eos=True), strict=True):
        assert [*map(int, ids.split()), own.end] == want and n + 1 == len(want), text[:80]
        assert back == library.decode(want) == own.decode(want), text[:80]


def test_equals_the_library(spark, own, library):
    equal(own, library, [r.text or "" for r in queries.documents(spark, SF).collect()] + ODD)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abcdehilnorst ▁\n  éß日😀က.,!0123456789ABC", max_size=40), min_size=1, max_size=5))
def test_any_text(own, library, texts):
    equal(own, library, texts)


def test_decoding_of_any_ids(own, library):
    rnd = random.Random(5)
    for _ in range(500):
        ids = [rnd.randrange(32_000) if rnd.random() < 0.5 else rnd.randrange(259) for _ in range(rnd.randint(0, 12))]
        assert own.decode(ids) == library.decode(ids), ids
    assert own.decode([-1, 32_000]) == " ⁇  ⁇ "


def test_backtracking_equals_joining(own):
    """On texts whose longest pieces mislead; the whole text is joined at once for comparison."""
    rnd = random.Random(3)
    for _ in range(300):
        text = "▁" + "".join(rnd.choice(["ing", "th", "er", "e", "r", "s", "ation", "at", "ion", "on", "n"]) for _ in range(rnd.randint(1, 8)))
        assert [own.text_of[x] for x in own.divide(text)] == own.join(text), text


def test_frames(spark, library):
    path = vocabulary("piece_bpe_32k.model")
    docs = spark.createDataFrame([*((i, t, "x") for i, t in enumerate(ODD)), (None, None, "x"), (0, "", "y")], "doc_id long, text string, ids string")
    ids = piece_bpe.encode(docs, path)
    assert sorted((r.doc_id, r.ids) for r in ids.filter("doc_id > 0").collect()) == [(i, library.encode(t, add_eos=True)) for i, t in enumerate(ODD) if i]
    back = {r.doc_id: r.text for r in piece_bpe.decode(ids, path).collect()}
    assert all(back[i] == t.replace("▁", " ") for i, t in enumerate(ODD))
    got = piece_bpe.round_trip(docs, path).collect()
    empty = {(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got if r.doc_id in (None, 0)}
    assert empty == {(1, hashlib.sha256(b"2").hexdigest(), hashlib.sha256(b"").hexdigest())} and len(got) == len(ODD) + 2
    lost = spark.createDataFrame([(1, [5, None, 40_000]), (2, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in piece_bpe.decode(lost, path).collect()}[2] == ""
    assert piece_bpe.round_trip(docs.limit(0), path).count() == 0
