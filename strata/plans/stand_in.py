"""Listing, review and landed-page inputs built from the driver tables.

The test tables hold no nested listings or review CSV, so the registered
queries derive them with Spark from ``lineitem``, ``part``, ``supplier``,
``documents`` and ``events``; their size grows with those tables. Nulls, empty
arrays, duplicates and text decorations are placed by key modulus so every
edge case of the rules is exercised, identically in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.keys import sent_if_small
from strata.schemas import SRC_FILE, SRC_ROW


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _i(c: Column) -> Column:
    return c.cast("int")


def _bit(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def category_path() -> Column:
    """3 to 6 path parts by p_partkey % 4, null when p_partkey % 17 = 0."""
    base = F.concat(F.lit("1/2/"), F.col("p_type"))
    b = F.concat(base, F.lit("/"), F.col("p_brand"))
    s = F.concat(b, F.lit("/s"), F.col("p_size").cast("string"))
    x = F.concat(s, F.lit("/x"), (F.col("p_partkey") % 3).cast("string"))
    k = F.col("p_partkey") % 4
    path = (F.when(k == 0, base).when(k == 1, b).when(k == 2, s).otherwise(x))
    return F.when(F.col("p_partkey") % 17 == 0, F.lit(None).cast("string")).otherwise(path)


def listing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that listings are made of, before they are widened: one per lineitem, with its
    part and supplier, and its ``category`` (return flag + line status, 6 of them).

    Suppliers (two numbers each) are sent to the lines where there are few enough. Parts come last, so
    that the lines leave dealt by product, and what groups them by product needs no shuffle of its own.
    """
    l = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    p = table(spark, sf_dir, "part")
    s = sent_if_small(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"))
    lines = l.join(s, l.l_suppkey == s.s_suppkey).join(p, l.l_partkey == p.p_partkey)
    return lines.withColumn("category", F.concat(F.lit("data_"), F.lower("l_returnflag"), F.lower("l_linestatus")))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested bronze listings: one per lineitem, product = part, seller = supplier.

    Category file = return flag + line status (6 files); file order =
    (l_orderkey, l_partkey, l_suppkey), which is unique.
    """
    return as_listings(listing_lines(spark, sf_dir))


def as_listings(lines: DataFrame) -> DataFrame:
    """Each line widened to its nested listing; rows stay where and in the order they are."""
    ok, pk, sk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    pkey = pk.cast("string")
    sku = (F.when(ln == 7, F.concat(pkey, F.lit(".0")))
            .when((ln == 6) & (ok % 5 == 0), F.concat(F.lit("SKU"), pkey))
            .otherwise(pkey))
    price = F.floor("l_extendedprice").cast("long")
    gift = F.struct(pk.alias("gift_id"))
    seller_type = (F.when(ok % 50 == 7, F.lit("MARKETPLACE"))
                    .when(sk % 4 == 0, F.lit("OFFICIAL_STORE"))
                    .when(sk % 4 == 1, F.lit("TRUSTED_STORE"))
                    .when(sk % 4 == 2, F.lit("MARKETPLACE")))
    top = F.length("p_brand") % 2
    amplitude = F.struct(
        _i(F.col("p_size") % 2).alias("is_imported"),
        _i(F.col("s_nationkey") % 2).alias("is_authentic"),
        _i(ln % 2).alias("tiki_verified"),
        F.when(ok % 8 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("origin-"), F.col("s_nationkey").cast("string"))).alias("origin"),
        seller_type.alias("seller_type"),
        F.col("p_type").alias("primary_category_name"),
        F.when(F.col("p_partkey") % 23 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_brand")).alias("brand_name"),
        _i(F.when(ok % 97 == 0, (F.length("p_brand") + 1) % 2).otherwise(top)).alias("is_top_brand"),
        _bit(ok % 3 == 0).alias("is_flash_deal"),
        _bit(sk % 5 == 0).alias("is_freeship_xtra"),
        _bit(ok % 13 != 0).alias("is_gift_available"),
        (F.col("l_discount") * 50).alias("product_rating"),
        F.floor(F.col("l_quantity") * 10).cast("long").alias("all_time_quantity_sold"),
        (ok % 1000).cast("long").alias("number_of_reviews"),
        (ok % 100).cast("long").alias("search_rank"),
    )
    meta = lambda cat: F.struct(F.struct(
        (ln <= 2).alias("is_tikinow"), (F.col("l_quantity") > 25).alias("is_tikipro"),
        (F.col("l_discount") > 0.05).alias("is_ad"), F.lit(True).alias("is_official_store"),
        F.lit(False).alias("is_trusted_store"), cat.alias("category")).alias("metadata"))
    impression = (F.when(ok % 11 == 0, F.lit(None))
                   .when(F.col("p_partkey") % 7 == 0, F.array().cast(
                       "array<struct<metadata:struct<is_tikinow:boolean,is_tikipro:boolean,is_ad:boolean,"
                       "is_official_store:boolean,is_trusted_store:boolean,category:string>>>"))
                   .otherwise(F.array(
                       meta(F.concat(F.col("p_type"), F.lit("-"), (F.col("p_size") % 5).cast("string"))),
                       meta(F.lit("second")))))
    return lines.select(
        pk.alias("id"), sku.alias("sku"), F.col("p_name").alias("name"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("-")).alias("url_key"),
        F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("-")), F.lit("-p"), pkey,
                 F.lit(".html")).alias("url_path"),
        F.when(ok % 10 == 3, F.lit(None).cast("int")).otherwise(ln).alias("availability"),
        F.col("l_linestatus").alias("inventory_status"),
        (F.col("l_returnflag") != "R").alias("is_visible"),
        F.when(ok % 13 == 0, F.lit(None)).otherwise(
            F.array_repeat(gift, _i(ln % 3))).alias("freegift_items"),
        (F.col("l_quantity") > 10).alias("shippable"),
        sk.alias("seller_id"),
        category_path().alias("primary_category_path"),
        (F.col("l_tax") > 0.05).alias("bundle_deal"),
        price.alias("price"), (price + 1).alias("list_price"),
        F.when(ok % 9 == 4, F.lit(None).cast("long"))
         .otherwise(F.floor(F.col("l_extendedprice") * F.col("l_discount")).cast("long")).alias("discount"),
        F.col("l_discount").alias("discount_rate"),
        F.when(ok % 8 == 1, F.lit(None).cast("double"))
         .otherwise(F.col("l_tax") * 100).alias("rating_average"),
        F.floor("l_quantity").cast("long").alias("review_count"),
        ln.cast("long").alias("favourite_count"),
        F.floor("p_retailprice").cast("long").alias("original_price"),
        F.struct(amplitude.alias("amplitude")).alias("visible_impression_info"),
        impression.alias("impression_info"),
        F.col("category").alias(SRC_FILE),
        F.struct(ok.alias("o"), pk.alias("p"), sk.alias("s")).alias(SRC_ROW),
    )


# ---- Review text decorations (stand-in for real review noise) -----------------
def decorate(text: Column, key: Column) -> Column:
    """Add emoji, URLs, tags, odd whitespace and punctuation by ``key % 6``."""
    k = key % 6
    ks = key.cast("string")
    return (F.when(k == 0, F.concat(F.lit("  <b>"), text, F.lit("</b> \U0001F600 ")))
             .when(k == 1, F.concat(text, F.lit(" see http://shop.example.com/p?id="), ks, F.lit(" now")))
             .when(k == 2, F.concat(F.lit("\u00a0\tĐÁNH GIÁ TỐT: "), text, F.lit("(ok)*!\u3000")))
             .when(k == 3, F.concat(F.lit('<a href="http://x.example/'), ks, F.lit('">'), text,
                                    F.lit("</a> z")))
             .when(k == 4, F.concat(text, F.lit(" 漢字 ✂ 100% #1 @me\r\nline\u2028<i\u2028>x</i>")))
             .otherwise(text))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze reviews from ``documents``: every document once, then a second copy of
    every 4th one with other content (keep-first must choose the first copy)."""
    d = table(spark, sf_dir, "documents")
    doc = F.col("doc_id")

    def shaped(copy: int, content: Column) -> DataFrame:
        return d.select(
            doc.alias("id"),
            F.when(doc % 31 == 5, F.lit(None).cast("long")).otherwise(doc % 97).alias("product_id"),
            F.when(doc % 29 == 3, F.lit(None).cast("double"))
             .otherwise((doc % 13).cast("double")).alias("seller_id"),
            F.col("source").alias("seller_name"), (doc * 7).alias("customer_id"),
            content.alias("content"), _i(doc % 5 + 1).alias("rating"),
            F.lit("review.csv").alias(SRC_FILE),
            F.struct(F.lit(copy).alias("c"), doc.alias("d")).alias(SRC_ROW),
        )

    first = shaped(0, F.when(doc % 10 == 0, F.lit(None).cast("string"))
                       .otherwise(decorate(F.col("text"), doc)))
    second = shaped(1, F.concat(F.lit("DUP "), F.col("text"))).where(doc % 4 == 0)
    return first.unionByName(second)


# Users of a category share user_id % CATEGORY_USERS; a page holds the events of PAGE_SPAN ids.
CATEGORY_USERS, PAGE_SPAN = 8, 1600


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored listing-API responses from ``events``: category = event type and user bucket,
    page = event_id // PAGE_SPAN. The page after (bucket + 1) ninths of all pages failed
    (status 500, even buckets) or came back empty (odd ones); bucket 7 has no bad page."""
    e = table(spark, sf_dir, "events")
    pages = F.floor(e.agg(F.max("event_id")).scalar() / PAGE_SPAN).cast("int") + 1
    bucket = (F.col("user_id") % CATEGORY_USERS).cast("int")
    category = F.concat_ws("-", "event_type", bucket.cast("string"))
    grouped = (e.select(category.alias("category"), bucket.alias("bucket"),
                        F.floor(F.col("event_id") / PAGE_SPAN).cast("int").alias("page"),
                        F.struct("event_id", "user_id", "value").alias("item"))
                .groupBy("category", "bucket", "page").agg(F.collect_list("item").alias("data")))
    bad = (F.col("bucket") < CATEGORY_USERS - 1) & (F.col("page") == F.floor(pages * (F.col("bucket") + 1) / (CATEGORY_USERS + 1)))
    status = F.when(bad & (F.col("bucket") % 2 == 0), F.lit(500)).otherwise(F.lit(200))
    data = F.when(bad & (F.col("bucket") % 2 == 1), F.array().cast(grouped.schema["data"].dataType)).otherwise(F.col("data"))
    return grouped.select("category", "page", status.alias("status"),
                          F.to_json(F.struct(data.alias("data"))).alias("body"))
