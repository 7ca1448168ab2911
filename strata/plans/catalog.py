"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables (or data Spark derives from them) in full.
The oracle SQL for each one is in :mod:`strata.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from strata.functions.columns import array_length, difference, flag, to_long
from strata.functions.text import clean_text
from strata.operators.dedup import dedup_any, distinct, keep_first, union_all
from strata.operators.keys import new_rows
from strata.operators.nested import flatten
from strata.operators.nulls import fill, fill_numeric, require
from strata.operators.profile import profile
from strata.plans import gold, silver
from strata.plans.medallion import run_concurrently
from strata.plans.stand_in import as_listings, decorate, landed_pages, listing_lines, listings, reviews, table
from strata.schemas import CATEGORY_NATURAL_KEY, REVIEW, SRC_FILE, SRC_ROW
from strata.session import materialize, scratch_path
from strata.sources.lake import PARQUET, read_csv, write_csv, write_parquet
from strata.sources.mart import LOAD_BATCH, LOAD_SOURCE, Load, ParquetMart
from strata.sources.pages import landed_rows

# ---- Fixed values used by the stand-in queries --------------------------------
BRANCHES = 3
UNKNOWN_ORIGIN = silver.UNKNOWN_ORIGIN
DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]
# Products already in the mart for product_rejoin.
KNOWN_PRODUCT_TYPES = ["ECONOMY", "PROMO"]
# Load 1 takes the category files of finished lines, load 2 the open ones.
LOAD1_FILES = ["data_af", "data_nf", "data_rf"]
# -------------------------------------------------------------------------------


# ---- P1/P2/P3, F2 ---------------------------------------------------------------
def nested_flatten(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    nested = p.select(F.col("p_partkey").alias("id"), F.struct(F.struct(
        F.col("p_brand").alias("brand_name"), F.col("p_type").alias("primary_category_name"),
        F.col("p_size").cast("long").alias("search_rank"),
        F.when(F.col("p_partkey") % 9 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("origin-"), F.col("p_size").cast("string"))).alias("origin"),
    ).alias("amplitude")).alias("visible_impression_info"))
    return flatten(nested, ["id", "visible_impression_info.amplitude.brand_name",
                            "visible_impression_info.amplitude.primary_category_name",
                            "visible_impression_info.amplitude.search_rank",
                            "visible_impression_info.amplitude.origin"])


def array_first_field(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    elem = lambda cat, ad: F.struct(F.struct(cat.alias("category"), ad.alias("is_ad")).alias("metadata"))
    arr = F.when(F.col("p_partkey") % 7 == 0,
                 F.array().cast("array<struct<metadata:struct<category:string,is_ad:boolean>>>")
                 ).otherwise(F.array(elem(F.col("p_type"), F.col("p_size") > 25),
                                     elem(F.lit("second"), F.lit(False))))
    nested = p.select(F.col("p_partkey").alias("id"), arr.alias("impression_info"))
    return flatten(nested, ["id", ("category", "impression_info.metadata.category", "first"),
                            ("is_ad", "impression_info.metadata.is_ad", "first")])


def array_length_q(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    words = F.when(F.col("doc_id") % 5 == 0, F.lit(None)).otherwise(F.split("text", " "))
    return docs.select("doc_id", array_length(words).alias("n_words"))


# ---- G2-G5 ----------------------------------------------------------------------
def dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    return keep_first(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"])


def dedup_any_q(spark: SparkSession, d: str) -> DataFrame:
    return dedup_any(table(spark, d, "events"), ["user_id", "event_type"]).select("user_id", "event_type")


def distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return distinct(table(spark, d, "part").select("p_brand", "p_type"))


def union_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Branches by a total rule (bucket of the event id; a null id is bucket 0), each
    with its own columns, put together by name."""
    e = table(spark, d, "events")
    bucket = F.coalesce(F.pmod(F.col("event_id"), F.lit(BRANCHES)), F.lit(0))
    parts = []
    for i in range(BRANCHES):
        branch = e.where(bucket == i)
        parts.append(branch.drop("props") if i == 1 else branch)
    return union_all(parts)


# ---- P11-P13 --------------------------------------------------------------------
def _null_when(c: str, cond) -> F.Column:
    return F.when(cond, F.lit(None)).otherwise(F.col(c)).alias(c)


def null_fill_constants(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    k = F.col("p_partkey")
    holed = p.select("p_partkey", _null_when("p_brand", k % 5 == 0),
                     _null_when("p_size", k % 7 == 0), _null_when("p_type", k % 11 == 0))
    return fill(holed, {"p_brand": UNKNOWN_ORIGIN, "p_size": 0, "p_type": gold.MISSING_LEVEL})


def null_fill_numeric(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    k = F.col("p_partkey")
    holed = p.select("p_partkey", _null_when("p_brand", k % 5 == 0),
                     _null_when("p_size", k % 7 == 0), _null_when("p_retailprice", k % 3 == 0))
    return fill_numeric(holed, 0)


def drop_null_keys(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    holed = li.select(_null_when("l_orderkey", F.col("l_orderkey") % 17 == 0),
                      _null_when("l_partkey", F.col("l_partkey") % 19 == 0),
                      _null_when("l_suppkey", F.col("l_suppkey") % 23 == 0), "l_linenumber")
    return require(holed, ["l_orderkey", "l_partkey", "l_suppkey"])


# ---- P4-P9, F1 ------------------------------------------------------------------
def enum_flags(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    seg = F.when(F.col("c_custkey") % 9 == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", seg.alias("c_mktsegment"),
                    flag(seg, "BUILDING").alias("is_official_store"),
                    flag(seg, "MACHINERY").alias("is_trusted_store"))


def price_override(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    ok = F.col("l_orderkey")
    base = li.select(
        "l_orderkey", "l_partkey", "l_suppkey",
        F.floor("l_extendedprice").cast("long").alias("price"),
        F.when(ok % 9 == 4, F.lit(None).cast("long"))
         .otherwise(F.floor(F.col("l_extendedprice") * F.col("l_discount")).cast("long")).alias("discount"),
        F.when(ok % 10 == 3, F.lit(None).cast("int")).otherwise(F.col("l_linenumber")).alias("availability"),
        "l_tax")
    filled = fill(base, {"availability": 0})
    return (filled.withColumn("list_price", difference("price", "discount"))
                  .withColumn("inventory_status", F.col("availability"))
                  .withColumnsRenamed({"l_orderkey": "order_id"})
                  .drop("l_tax"))


def cast_keys(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    text = (F.when(k % 13 == 0, F.concat(k.cast("string"), F.lit("x")))
             .when(k % 17 == 0, F.concat(k.cast("string"), F.lit(".0")))
             .otherwise(k.cast("string")))
    return o.select("o_orderkey", text.alias("key_text"), to_long(text, strict=False).alias("key_long"))


def path_levels(spark: SparkSession, d: str) -> DataFrame:
    pg = table(spark, d, "pages").select("page_id", F.col("url").alias("primary_category_path"))
    return gold.with_category_levels(pg)


# ---- F3-F11 ---------------------------------------------------------------------
def clean_text_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", clean_text(decorate(F.col("text"), F.col("doc_id"))).alias("content"))


def clean_text_pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", clean_text("html").alias("content"))


def clean_text_conversations(spark: SparkSession, d: str) -> DataFrame:
    cv = table(spark, d, "conversations")
    return cv.select("conv_id", "turn",
                     clean_text(decorate(F.col("text"), F.col("conv_id") + F.col("turn"))).alias("content"))


# ---- J1-J3, T11 -----------------------------------------------------------------
def _suppliers_holed(spark, d):
    s = table(spark, d, "supplier")
    k = F.col("s_suppkey")
    return s.select(F.when(k % 10 == 1, F.lit(None)).otherwise(k).alias("s_suppkey"),
                    "s_name", "s_nationkey", (F.col("s_nationkey") < 10).alias("_known"))


def new_keys_single(spark: SparkSession, d: str) -> DataFrame:
    inc = _suppliers_holed(spark, d)
    existing = inc.where("_known")
    return new_rows(inc, existing, ["s_suppkey"]).drop("_known")


def _brand_type_size(spark, d):
    p = table(spark, d, "part")
    return distinct(p.select(
        F.when(F.col("p_partkey") % 11 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("p_brand"),
        "p_type", "p_size"))


def new_keys_composite(spark: SparkSession, d: str) -> DataFrame:
    inc = _brand_type_size(spark, d)
    return new_rows(inc, inc.where(F.col("p_size") <= 20), ["p_brand", "p_type", "p_size"])


def new_keys_null_unsafe(spark: SparkSession, d: str) -> DataFrame:
    inc = _brand_type_size(spark, d)
    return new_rows(inc, inc.where(F.col("p_size") <= 20), ["p_brand", "p_type", "p_size"],
                    null_safe=False)


def product_rejoin(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part")
    pk = F.col("l_partkey")
    inc = li.join(p, li.l_partkey == p.p_partkey).select(
        pk.alias("product_id"),
        F.when(F.col("l_linenumber") == 7, F.concat(pk.cast("string"), F.lit(".0")))
         .when(F.col("l_linenumber") == 6, F.concat(F.lit("SKU"), pk.cast("string")))
         .otherwise(pk.cast("string")).alias("sku"),
        F.col("p_name").alias("name"), F.floor("l_extendedprice").cast("long").alias("price"),
        "l_orderkey", "l_suppkey")
    existing = p.where(F.col("p_type").isin(KNOWN_PRODUCT_TYPES)).select(F.col("p_partkey").alias("product_id"))
    new = new_rows(inc, existing, ["product_id"])
    first = keep_first(new, ["product_id"], ["l_orderkey", "product_id", "l_suppkey"])
    return first.select("product_id", to_long("sku", strict=False).alias("sku"), "name", "price")


def surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    existing = distinct(p.where(F.length("p_brand") == 7).select(
        (F.substring("p_brand", 7, 10).cast("long") * 10).alias("brand_id"),
        F.col("p_brand").alias("brand_name")))
    incoming = distinct(p.select(F.col("p_brand").alias("brand_name")))
    new = gold.new_dimension_rows(incoming, existing, ["brand_name"], surrogate="brand_id")
    return existing.unionByName(new)


# ---- T3-T9 on stand-in listings --------------------------------------------------
# Silver columns each dimension reads (besides provenance).
DIM_INPUTS = {
    "dim_seller": ["seller_id", "seller_type", "is_official_store", "is_trusted_store"],
    "dim_category": list(CATEGORY_NATURAL_KEY),
    "dim_brand": ["brand_name", "is_top_brand"],
    "dim_product": ["id", "sku", "name", "url_key", "url_path", "availability", "is_imported",
                    "is_authentic", "tiki_verified", "is_tikinow", "is_tikipro", "is_ad",
                    "inventory_status", "is_visible", "origin", "freegift_items", "shippable"],
}


def silver_all(spark: SparkSession, d: str, columns: list[str] | None = None) -> DataFrame:
    """Silver products with provenance, materialized once (as the silver layer is
    written once in the jobs), so the dimension and fact steps read it back
    instead of re-deriving the listings for every use. With ``columns`` only
    those are kept, and the listing build is pruned to what they need."""
    s = silver.silver_products(listings(spark, d))
    if columns is not None:
        s = s.select(*dict.fromkeys([*columns, SRC_FILE, SRC_ROW]))
    return materialize(s, "silver")


def _loads(spark, d, s=None):
    s = silver_all(spark, d) if s is None else s
    in1 = F.col(SRC_FILE).isin(LOAD1_FILES)
    return s.where(in1), s.where(~in1)


def two_load_dims(spark: SparkSession, d: str, s: DataFrame | None = None,
                  only: list[str] | None = None) -> dict[str, DataFrame]:
    """Dimensions after load 1 (empty mart) and load 2, without writing to a mart."""
    if s is None and only:
        s = silver_all(spark, d, [c for name in only for c in DIM_INPUTS[name]])
    load1, load2 = _loads(spark, d, s)
    def build(name):
        rows_of, key, surrogate = gold.DIMENSIONS[name]
        r1 = rows_of(load1)
        empty_mart = spark.createDataFrame([], r1.schema if surrogate is None else
                                           r1.withColumn(surrogate, F.lit(None).cast("long")).schema)
        first = gold.new_dimension_rows(r1, empty_mart, key, surrogate=surrogate,
                                        start=0 if surrogate else None)
        first = materialize(first, name)  # read twice: by the anti join and the union
        second = gold.new_dimension_rows(rows_of(load2), first, key, surrogate=surrogate)
        # the dimension as the mart holds it after both loads
        return materialize(first.unionByName(second), name)

    return run_concurrently(build, [n for n in gold.DIMENSIONS if not only or n in only])


def dim_seller(spark, d):
    return two_load_dims(spark, d, only=["dim_seller"])["dim_seller"]


def dim_category(spark, d):
    return two_load_dims(spark, d, only=["dim_category"])["dim_category"]


def dim_brand(spark, d):
    return two_load_dims(spark, d, only=["dim_brand"])["dim_brand"]


def dim_product(spark, d):
    return two_load_dims(spark, d, only=["dim_product"])["dim_product"]


def fact_star_join(spark: SparkSession, d: str) -> DataFrame:
    s = silver_all(spark, d)
    dims = two_load_dims(spark, d, s)
    return gold.fact_rows(s, dims["dim_product"], dims["dim_seller"],
                          dims["dim_category"], dims["dim_brand"])


def dim_seller_full_row(spark: SparkSession, d: str) -> DataFrame:
    """Reference rule (strict=False): full-row distinct, so a seller seen with two
    seller types keeps two rows."""
    return gold.seller_rows(silver_all(spark, d, DIM_INPUTS["dim_seller"]), strict=False)


def silver_products_q(spark: SparkSession, d: str) -> DataFrame:
    return silver.silver_products(listings(spark, d), provenance=False)


def silver_reviews_q(spark: SparkSession, d: str) -> DataFrame:
    return silver.silver_reviews(reviews(spark, d))


# ---- K5/G1, S6 -------------------------------------------------------------------
def table_profile(spark: SparkSession, d: str) -> DataFrame:
    return union_all([profile(table(spark, d, t), t) for t in DRIVER_TABLES])


EVENT_ITEM = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()),
                         StructField("value", DoubleType())])


def page_landing(spark: SparkSession, d: str) -> DataFrame:
    """Categories of events; bad pages lie at fixed shares of a category, so that the
    rows kept grow with the table."""
    rows = landed_rows(landed_pages(spark, d), EVENT_ITEM)
    return rows.select("category", "page", "event_id", "user_id", "value")


# ---- round trips (S1-S5, K1-K4) --------------------------------------------------
def parquet_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "orders")
    write_parquet(table(spark, d, "orders"), path, partition_by=["o_orderstatus"])
    return spark.read.parquet(path)


def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Columns written in another order and with one more; found by name, the further one carried."""
    path = scratch_path(spark, "reviews_csv")
    shuffled = ["rating", "content", "note", "seller_id", "id", "seller_name", "product_id", "customer_id"]
    write_csv(reviews(spark, d).withColumn("note", F.concat(F.lit("n"), F.col("id").cast("string"))).select(*shuffled), path)
    return read_csv(spark, path, REVIEW).drop(SRC_FILE, SRC_ROW)


def mart_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    mart = ParquetMart(spark, scratch_path(spark, "mart"))
    s = table(spark, d, "supplier").select("s_suppkey", "s_name")
    mart.append(s, "dim_supplier")
    mart.append(s, "dim_supplier")
    return mart.read("dim_supplier")


def in_file_order(lines: DataFrame) -> DataFrame:
    """The listings of ``lines``, range-partitioned in file order. Lines are put in order before they are
    widened to listings, so that the shuffle and the sort carry few bytes a row."""
    order = ["category", "l_orderkey", "l_partkey", "l_suppkey"]
    return as_listings(lines.repartitionByRange(*order).sortWithinPartitions(*order))


def land_listings(lines: DataFrame, listing_dir: str) -> str:
    """Write listings as category folders in file order (files named in that order)."""
    (in_file_order(lines).withColumnRenamed(SRC_FILE, "category").drop(SRC_ROW)
        .write.partitionBy("category").options(**PARQUET).parquet(listing_dir))
    return listing_dir


def land_reviews(spark: SparkSession, d: str, review_dir: str) -> str:
    """Write the stand-in reviews as CSV files, range-partitioned in file order (files named in that order)."""
    write_csv(reviews(spark, d).repartitionByRange(SRC_ROW).sortWithinPartitions(SRC_ROW).drop(SRC_FILE, SRC_ROW), review_dir)
    return review_dir


def land_stand_in(spark: SparkSession, d: str, root: str) -> tuple[str, str]:
    """Write the stand-in listings as category folders and the reviews as CSV files,
    each range-partitioned in file order (files named in that order)."""
    return land_listings(listing_lines(spark, d), f"{root}/listings"), land_reviews(spark, d, f"{root}/reviews")


def _land_part(spark: SparkSession, d: str, category, part: str) -> str:
    """Some categories of the listings, in a landing folder of their own and in the same order."""
    return land_listings(listing_lines(spark, d).where(category), part)


def land_in_parts(spark: SparkSession, d: str, listing_dir: str) -> list[str]:
    """The listings of load 1, of load 2 and of neither (without a category), a folder each under ``listing_dir``,
    which holds all of them: every listing is landed once. The folders of the two loads."""
    first, none = F.col("category").isin(LOAD1_FILES), F.col("category").isNull()
    return [_land_part(spark, d, some, f"{listing_dir}/part={i}") for i, some in enumerate((none, first, ~first))][1:]


def _lake_and_mart(spark: SparkSession, name: str):
    """An empty folder, lake and mart."""
    from strata.plans.medallion import Lake
    root = scratch_path(spark, name)
    return root, Lake(f"{root}/lake"), ParquetMart(spark, f"{root}/mart")


def _landed(spark: SparkSession, d: str, name: str):
    """A lake and a mart of its own, and the stand-in files landed for them."""
    root, lake, mart = _lake_and_mart(spark, name)
    listing_dir, review_dir = land_stand_in(spark, d, f"{root}/landing")
    return root, listing_dir, review_dir, lake, mart


def _landed_parts(spark: SparkSession, d: str, name: str):
    """The same with the listings in parts: (root, folder of all, folders of load 1 and load 2, reviews, lake, mart)."""
    root, lake, mart = _lake_and_mart(spark, name)
    listing_dir = f"{root}/landing/listings"
    return root, listing_dir, land_in_parts(spark, d, listing_dir), land_reviews(spark, d, f"{root}/landing/reviews"), lake, mart


def medallion_run(spark: SparkSession, d: str) -> DataFrame:
    """T1-T12 from landed files (category folders and CSV files written in file order by
    many tasks) into a Parquet mart. Returns the rows and columns that every job wrote."""
    from strata.plans.medallion import run
    _, listing_dir, review_dir, lake, mart = _landed(spark, d, "medallion_run")
    return run(spark, listing_dir, review_dir, lake, mart, load_id="first", partition_column="category").drop("current_rows")


def _without_load(df: DataFrame) -> DataFrame:
    return df.drop(LOAD_SOURCE, LOAD_BATCH)


def medallion_fact(spark: SparkSession, d: str) -> DataFrame:
    """The fact rows of a full run from landed nested files, run twice under one load id."""
    from strata.plans.medallion import run
    _, listing_dir, review_dir, lake, mart = _landed(spark, d, "medallion_fact")
    for _ in range(2):
        run(spark, listing_dir, review_dir, lake, mart, load_id="first", partition_column="category")
    return _without_load(mart.read("fact"))


def medallion_reviews(spark: SparkSession, d: str) -> DataFrame:
    """The review rows in the mart of reviews that arrived as files."""
    from strata.streaming.incremental import run_reviews_available_now
    root, _, review_dir, lake, mart = _landed(spark, d, "medallion_reviews")
    for _ in range(2):  # the second run finds nothing new
        run_reviews_available_now(spark, review_dir, lake, mart, f"{root}/checkpoint")
    return _without_load(mart.read("review"))


def medallion_loads(spark: SparkSession, d: str) -> DataFrame:
    """Facts of three loads into one mart: the files of load 1 and then of load 2 through
    two stream checkpoints, then all files through a batch run."""
    from strata.plans.medallion import run
    from strata.streaming.incremental import run_available_now
    root, listing_dir, parts, review_dir, lake, mart = _landed_parts(spark, d, "medallion_loads")
    for i, part in enumerate(parts):
        run_available_now(spark, part, lake, mart, f"{root}/checkpoint{i}", partition_column="category")
    run(spark, listing_dir, review_dir, lake, mart, load_id="all", partition_column="category")
    kinds = F.when(F.col(LOAD_SOURCE).startswith("stream"), F.lit("stream")).otherwise(F.col(LOAD_SOURCE))
    return mart.read("fact").withColumn("load", kinds).drop(LOAD_SOURCE, LOAD_BATCH)


def _reloaded(spark: SparkSession, d: str, name: str):
    """A load of all categories, loaded again with those of load 1 only."""
    from strata.plans.medallion import run
    _, listing_dir, (less, _), review_dir, lake, mart = _landed_parts(spark, d, name)
    run(spark, listing_dir, review_dir, lake, mart, load_id="first", partition_column="category")
    run(spark, less, review_dir, lake, mart, load_id="first", partition_column="category")
    return lake, mart


def medallion_reload(spark: SparkSession, d: str) -> DataFrame:
    """Facts of a load that was loaded again with fewer categories: the new files' only."""
    return _without_load(_reloaded(spark, d, "medallion_reload")[1].read("fact"))


def medallion_reload_dims(spark: SparkSession, d: str) -> DataFrame:
    """Lake copies of the dimensions of such a load: what it brought, whichever attempt brought it."""
    from strata.plans.medallion import read_layer
    lake, mart = _reloaded(spark, d, "medallion_reload_dims")
    shown = {"dim_seller": ("seller_id", "seller_type"), "dim_category": ("category_id", "category"),
             "dim_brand": ("brand_id", "brand_name"), "dim_product": ("product_id", "name")}
    return union_all([read_layer(spark, lake, mart, "gold", t, Load.of_run("first")).select(
        F.lit(t).alias("table_name"), F.col(key).alias("key"), F.col(text).alias("text")) for t, (key, text) in shown.items()])


def medallion_profiles(spark: SparkSession, d: str) -> DataFrame:
    """K5 of a second load: rows that each job wrote, and rows of the table as it is afterwards."""
    from strata.plans.medallion import run
    _, _, (part1, part2), review_dir, lake, mart = _landed_parts(spark, d, "medallion_profiles")
    run(spark, part1, review_dir, lake, mart, load_id="1", partition_column="category")
    return run(spark, part2, review_dir, lake, mart, load_id="2", partition_column="category")


def medallion_two_loads(spark: SparkSession, d: str) -> DataFrame:
    """Gold loads 1 and 2 into a Parquet mart; profile of every table afterwards."""
    from strata.plans.medallion import Lake, load_gold
    root = scratch_path(spark, "medallion")
    lake, mart = Lake(f"{root}/lake"), ParquetMart(spark, f"{root}/mart")
    load1, load2 = _loads(spark, d)
    load_gold(spark, load1, lake, mart, Load.of_run("1"))
    tables, _ = load_gold(spark, load2, lake, mart, Load.of_run("2"))
    tables["fact"] = _without_load(tables["fact"])
    return union_all([profile(tables[t], t) for t in
                      ["dim_seller", "dim_category", "dim_brand", "dim_product", "fact"]])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fact_star_join": fact_star_join,
    "nested_flatten": nested_flatten,
    "array_first_field": array_first_field,
    "array_length": array_length_q,
    "dedup_keep_first": dedup_keep_first,
    "dedup_any": dedup_any_q,
    "distinct_rows": distinct_rows,
    "union_partitions": union_partitions,
    "null_fill_constants": null_fill_constants,
    "null_fill_numeric": null_fill_numeric,
    "drop_null_keys": drop_null_keys,
    "enum_flags": enum_flags,
    "price_override": price_override,
    "cast_keys": cast_keys,
    "path_levels": path_levels,
    "clean_text_documents": clean_text_documents,
    "clean_text_pages": clean_text_pages,
    "clean_text_conversations": clean_text_conversations,
    "new_keys_single": new_keys_single,
    "new_keys_composite": new_keys_composite,
    "new_keys_null_unsafe": new_keys_null_unsafe,
    "product_rejoin": product_rejoin,
    "surrogate_keys": surrogate_keys,
    "dim_seller": dim_seller,
    "dim_category": dim_category,
    "dim_brand": dim_brand,
    "dim_product": dim_product,
    "dim_seller_full_row": dim_seller_full_row,
    "silver_products": silver_products_q,
    "silver_reviews": silver_reviews_q,
    "table_profile": table_profile,
    "page_landing": page_landing,
    "parquet_roundtrip": parquet_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "mart_roundtrip": mart_roundtrip,
    "medallion_two_loads": medallion_two_loads,
    "medallion_run": medallion_run,
    "medallion_fact": medallion_fact,
    "medallion_reviews": medallion_reviews,
    "medallion_loads": medallion_loads,
    "medallion_reload": medallion_reload,
    "medallion_reload_dims": medallion_reload_dims,
    "medallion_profiles": medallion_profiles,
}
