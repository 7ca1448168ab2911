"""Silver jobs: T3 (products) and T4 (reviews), as lazy DataFrame transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import array_length, difference, first_of, flag, to_long
from strata.functions.text import clean_text
from strata.operators.dedup import keep_first, keep_first_placed
from strata.operators.nulls import require
from strata.schemas import SILVER_PRODUCT_COLUMNS, SRC_FILE, SRC_ROW

# ---- Fixed values (must equal the reference's rules) -------------------------
# Fill for a missing product origin ("unknown origin").
UNKNOWN_ORIGIN = "Không rõ nguồn gốc"
# seller_type values that set the store flags.
OFFICIAL_STORE = "OFFICIAL_STORE"
TRUSTED_STORE = "TRUSTED_STORE"
# Columns that identify a listing inside one category file.
PRODUCT_DEDUP_KEYS = ["id", "sku", "name", "url_key", "url_path"]
# Review identity and the columns dropped from reviews.
REVIEW_KEYS = ["id", "product_id", "seller_id"]
REVIEW_DROPPED = ["seller_name", "customer_id"]
# -------------------------------------------------------------------------------

_AMP = "visible_impression_info.amplitude."
_META = "impression_info.metadata."


def silver_product_columns(bronze: DataFrame) -> dict:
    """The silver columns that come from the bronze listing, as expressions over one row."""
    availability = F.coalesce(F.col("availability"), F.lit(0).cast("int"))
    amp = lambda f: F.col(_AMP + f)
    meta_first = lambda f: first_of(F.col(_META + f))
    return {
        "id": F.col("id"), "sku": F.col("sku"), "name": F.col("name"),
        "url_key": F.col("url_key"), "url_path": F.col("url_path"),
        "availability": availability,
        "is_imported": amp("is_imported"), "is_authentic": amp("is_authentic"),
        "tiki_verified": amp("tiki_verified"),
        "is_tikinow": meta_first("is_tikinow"), "is_tikipro": meta_first("is_tikipro"),
        "is_ad": meta_first("is_ad"),
        "is_visible": F.col("is_visible"),
        "origin": F.coalesce(amp("origin"), F.lit(UNKNOWN_ORIGIN)),
        "freegift_items": array_length("freegift_items"),
        "shippable": F.col("shippable"), "seller_id": F.col("seller_id"),
        "seller_type": amp("seller_type"),
        "primary_category_path": F.col("primary_category_path"),
        "category": meta_first("category"),
        "primary_category_name": amp("primary_category_name"),
        "brand_name": amp("brand_name"), "is_top_brand": amp("is_top_brand"),
        "is_flash_deal": amp("is_flash_deal"), "is_freeship_xtra": amp("is_freeship_xtra"),
        "is_gift_available": amp("is_gift_available"), "bundle_deal": F.col("bundle_deal"),
        "price": F.col("price"),
        "discount": F.col("discount"), "discount_rate": F.col("discount_rate"),
        "product_rating": amp("product_rating"), "rating_average": F.col("rating_average"),
        "review_count": F.col("review_count"), "favourite_count": F.col("favourite_count"),
        "original_price": F.col("original_price"),
        "all_time_quantity_sold": amp("all_time_quantity_sold"),
        "number_of_reviews": amp("number_of_reviews"), "search_rank": amp("search_rank"),
    }


def derived_columns() -> dict:
    """Silver columns that follow from other silver columns."""
    return {
        # copy of availability after its fill (the reference's override)
        "inventory_status": F.col("availability"),
        "is_official_store": flag("seller_type", OFFICIAL_STORE),
        "is_trusted_store": flag("seller_type", TRUSTED_STORE),
        # delivered list_price is always replaced (null when discount is null)
        "list_price": difference("price", "discount"),
    }


def silver_products(bronze: DataFrame, provenance: bool = True, placed: bool = False) -> DataFrame:
    """Flatten, keep the first listing per (category file, 5 identity columns), derive.

    ``bronze`` carries ``_src_file`` (category file) and ``_src_row`` (position in
    the file, any orderable type). The per-row rules on nested values are evaluated before the
    single shuffle (the dedup), which then carries 38 flat columns instead of the
    nested listing; columns that follow from these are added after it. The dedup scope is one category file, so a product listed in
    two categories keeps two rows. With ``placed`` (``bronze`` is a written layer, ``_src_row`` its rows' :func:`~strata.sources.lake.file_position`)
    the dedup shuffles its keys only.
    """
    later = derived_columns()
    flat = bronze.select(*[e.alias(n) for n, e in silver_product_columns(bronze).items()], SRC_FILE, SRC_ROW)
    keys = [SRC_FILE, *PRODUCT_DEDUP_KEYS]
    first = keep_first_placed(flat, keys, [SRC_ROW], SRC_ROW) if placed else keep_first(flat, keys, [SRC_ROW])
    return first.select(*[later[c].alias(c) if c in later else F.col(c) for c in SILVER_PRODUCT_COLUMNS], *([SRC_FILE, SRC_ROW] if provenance else []))


def silver_reviews(bronze: DataFrame, order: list | None = None, strict_cast: bool = True,
                   provenance: bool = False) -> DataFrame:
    """T4, in the reference's order: keep first per (id, product_id, seller_id) in file
    order -> drop rows with a null key -> content null to '' -> seller_id to long ->
    drop seller_name, customer_id -> clean content."""
    order = order or [SRC_FILE, SRC_ROW]
    first = keep_first(bronze, REVIEW_KEYS, order)
    kept = require(first, REVIEW_KEYS)
    out = (kept.withColumn("seller_id", to_long("seller_id", strict=strict_cast))
               .drop(*REVIEW_DROPPED)
               .withColumn("content", clean_text("content")))
    if not provenance:
        out = out.drop(SRC_FILE, SRC_ROW)
    return out
