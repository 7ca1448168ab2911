import pytest

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, row int, text_key string, key int, sha string, node string, bucket double, c0 array<int>"


def frame(spark, rows):
    """Documents with further columns whose names operators use inside."""
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), "x", 1, "y", 2, "z", "n", 0.5, [1]) for i, t, lang in rows], DOCS)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties and repeated rows."""
    base = "the quick brown fox jumps over the lazy dog while seven wizards brew potent jugs of ale tonight"
    rows = [(1, base, "en"), (2, base, "en"), (2, base, "en"), (2, "another text under the same id", "en"), (3, None, "en"), (4, "", "de"),
            (5, " \n\t ", None), (None, base, None), (None, None, None), (6, LONG, "fr"), (7, LONG + " end", "fr"), (8, "12 34 !!", "es"),
            (9, "i d i o t", "en"), (10, "one", "en"), (11, base + " indeed", "en"), (12, "　 é ñ ß", "de")]
    return frame(spark, rows)


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])
