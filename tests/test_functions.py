"""Column rules (P3, P8, P9, F1, F2) and text cleaning."""

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from strata.functions.columns import array_length, first_of, flag, path_level, to_long
from strata.functions.text import clean_text

# Written by hand from the rules: lower, strip, line ends to blanks, then emoji (a range
# that takes CJK too), URLs, tags and the signs ()*!@#$%^ out.
TEXT_CASES = [
    (None, ""),
    ("", ""),
    ("   ", ""),
    ("Hello World", "hello world"),
    ("  <a href=\"http://x\">t</a> z", "<a href=\" z"),
    ("Visit https://shop.example.com/p?id=1 now!!!", "visit  now"),
    ("line1\nline2\tTab\rCR", "line1 line2 tab cr"),
    ("\u00a0 padded \u3000", "padded"),
    ("tag <b\u2028x>in</b> tag", "tag in tag"),
    ("İstanbul ΟΔΟΣ", "i\u0307stanbul οδος"),
    ("漢字 かな 한글 \ue000 private ✂ scissors 😀 smile 🚀", "    private  scissors  smile "),
    ("100% (ok)* !@#$%^ done", "100 ok  done"),
    ("ĐÁNH GIÁ TỐT: Sản phẩm <i>rất</i> đẹp 👍", "đánh giá tốt: sản phẩm rất đẹp "),
    ("unclosed <tag and http", "unclosed <tag and http"),
    ("\u2028start and end\u2029", "start and end"),
    ("x<y>z\n<q>", "xz "),
]


def test_clean_text(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TEXT_CASES)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", clean_text("t").alias("c")).collect()}
    assert got == {i: c for i, (_, c) in enumerate(TEXT_CASES)}


def test_lenient_cast_is_exact(spark):
    df = spark.createDataFrame([("9007199254740993.0",), ("12",), ("3.7",), ("x",), ("5.",)], "s string")
    assert [r[0] for r in df.select(to_long("s", strict=False)).collect()] == [9007199254740993, 12, 3, None, 5]


def test_clean_text_order_effects(spark):
    df = spark.createDataFrame([('<a href="http://x">t</a> z',)], "t string")
    # URL removal precedes tag removal
    assert df.select(clean_text("t")).first()[0] == '<a href=" z'


def test_path_level(spark):
    df = spark.createDataFrame([("1/2/a/b/c/d/e",), ("1/2/a",), (None,)], "p string")
    rows = df.select(*[path_level("p", n).alias(f"l{n}") for n in (2, 3, 4, 5)]).collect()
    assert tuple(rows[0]) == ("a", "b", "c", "d")
    assert tuple(rows[1]) == ("a", None, None, None)
    assert tuple(rows[2]) == (None, None, None, None)


def test_to_long_lenient_and_strict(spark):
    df = spark.createDataFrame([("12",), ("12.0",), ("12.7",), ("x1",), (None,)], "s string")
    got = [r[0] for r in df.select(to_long("s", strict=False)).collect()]
    assert got == [12, 12, 12, None, None]
    ok = spark.createDataFrame([("5",)], "s string").select(to_long("s")).first()[0]
    assert ok == 5


def test_first_of_and_length(spark):
    schema = StructType([StructField("a", ArrayType(StringType())), StructField("k", LongType())])
    df = spark.createDataFrame([(["x", "y"], 1), ([], 2), (None, 3)], schema)
    rows = df.orderBy("k").select(first_of("a").alias("f"), array_length("a").alias("n")).collect()
    assert [(r.f, r.n) for r in rows] == [("x", 2), (None, 0), (None, 0)]


def test_flag(spark):
    df = spark.createDataFrame([("OFFICIAL_STORE",), ("TRUSTED_STORE",), ("other",), (None,)], "t string")
    assert [r[0] for r in df.select(flag("t", "OFFICIAL_STORE")).collect()] == [1, 0, 0, 0]


def test_array_of_struct_field_first(spark):
    df = spark.createDataFrame(
        [([{"metadata": {"category": "c1"}}, {"metadata": {"category": "c2"}}],), ([],), (None,)],
        "impression_info array<struct<metadata:struct<category:string>>>")
    got = [r[0] for r in df.select(first_of(F.col("impression_info.metadata.category"))).collect()]
    assert got == ["c1", None, None]
