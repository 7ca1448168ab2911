"""Explicit schemas for the inputs and outputs of the medallion jobs (see FIXTURES.md).

The reference infers every schema; here each input is read with a declared
``StructType`` so a drifted file fails at scan time instead of deep in a job.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType)


def _f(name, t, nullable=True):
    return StructField(name, t, nullable)


AMPLITUDE = StructType([
    _f("is_imported", IntegerType()), _f("is_authentic", IntegerType()),
    _f("tiki_verified", IntegerType()), _f("origin", StringType()),
    _f("seller_type", StringType()), _f("primary_category_name", StringType()),
    _f("brand_name", StringType()), _f("is_top_brand", IntegerType()),
    _f("is_flash_deal", IntegerType()), _f("is_freeship_xtra", IntegerType()),
    _f("is_gift_available", IntegerType()), _f("product_rating", DoubleType()),
    _f("all_time_quantity_sold", LongType()), _f("number_of_reviews", LongType()),
    _f("search_rank", LongType()),
])

IMPRESSION_METADATA = StructType([
    _f("is_tikinow", BooleanType()), _f("is_tikipro", BooleanType()), _f("is_ad", BooleanType()),
    _f("is_official_store", BooleanType()), _f("is_trusted_store", BooleanType()),
    _f("category", StringType()),
])

GIFT = StructType([_f("gift_id", LongType())])

# Bronze listing (one file per crawled category).
LISTING = StructType([
    _f("id", LongType()), _f("sku", StringType()), _f("name", StringType()),
    _f("url_key", StringType()), _f("url_path", StringType()),
    _f("availability", IntegerType()), _f("inventory_status", StringType()),
    _f("is_visible", BooleanType()), _f("freegift_items", ArrayType(GIFT)),
    _f("shippable", BooleanType()), _f("seller_id", LongType()),
    _f("primary_category_path", StringType()), _f("bundle_deal", BooleanType()),
    _f("price", LongType()), _f("list_price", LongType()), _f("discount", LongType()),
    _f("discount_rate", DoubleType()), _f("rating_average", DoubleType()),
    _f("review_count", LongType()), _f("favourite_count", LongType()),
    _f("original_price", LongType()),
    _f("visible_impression_info", StructType([_f("amplitude", AMPLITUDE)])),
    _f("impression_info", ArrayType(StructType([_f("metadata", IMPRESSION_METADATA)]))),
])

# Review CSV: the columns the jobs touch. Further columns are carried when the
# caller passes a wider schema.
REVIEW = StructType([
    _f("id", LongType()), _f("product_id", LongType()), _f("seller_id", DoubleType()),
    _f("seller_name", StringType()), _f("customer_id", LongType()),
    _f("content", StringType()), _f("rating", IntegerType()),
])

# Landed listing-API responses (the crawler's data half): one row per page.
LANDED_PAGE = StructType([
    _f("category", StringType()), _f("page", IntegerType()),
    _f("status", IntegerType()), _f("body", StringType()),
])

# Silver product column order (42 columns).
SILVER_PRODUCT_COLUMNS = [
    "id", "sku", "name", "url_key", "url_path", "availability",
    "is_imported", "is_authentic", "tiki_verified", "is_tikinow", "is_tikipro", "is_ad",
    "inventory_status", "is_visible", "origin", "freegift_items", "shippable",
    "seller_id", "seller_type", "is_official_store", "is_trusted_store",
    "primary_category_path", "category", "primary_category_name",
    "brand_name", "is_top_brand", "is_flash_deal", "is_freeship_xtra", "is_gift_available",
    "bundle_deal", "price", "list_price", "discount", "discount_rate", "product_rating",
    "rating_average", "review_count", "favourite_count", "original_price",
    "all_time_quantity_sold", "number_of_reviews", "search_rank",
]

# Provenance carried from bronze to gold: source file and row position in it.
SRC_FILE, SRC_ROW = "_src_file", "_src_row"

DIM_SELLER_COLUMNS = ["seller_id", "seller_type", "is_official_store", "is_trusted_store"]
CATEGORY_NATURAL_KEY = ["category", "primary_category_path", "primary_category_name"]
DIM_CATEGORY_COLUMNS = ["category_id", *CATEGORY_NATURAL_KEY,
                        "category_l1_name", "category_l2_name", "category_l3_name", "category_l4_name"]
DIM_BRAND_COLUMNS = ["brand_id", "brand_name", "is_top_brand"]
DIM_PRODUCT_COLUMNS = [
    "product_id", "sku", "name", "url_key", "url_path", "availability", "is_imported",
    "is_authentic", "tiki_verified", "is_tikinow", "is_tikipro", "is_ad", "inventory_status",
    "is_visible", "origin", "freegift_items", "shippable",
]
FACT_MEASURES = [
    "price", "list_price", "discount", "discount_rate", "rating_average", "review_count",
    "favourite_count", "original_price", "all_time_quantity_sold", "number_of_reviews",
    "search_rank",
]
FACT_COLUMNS = ["product_id", "seller_id", "category_id", "brand_id", *FACT_MEASURES]
