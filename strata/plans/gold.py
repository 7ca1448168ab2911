"""Gold jobs: dimensions (T5-T8), surrogate keys (T11), fact (T9), reviews.

The ``*_rows`` functions are lazy and write nothing: they turn silver rows into
one row per natural key. ``load_dimension`` does the I/O: new rows
are found with an anti join against the mart, written to the lake first, read
back, and only then added to the mart -- so the lake copy is exactly what was
added (the reference's lazy frame re-read the mart after the append and
wrote an empty lake copy).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import path_level, to_long
from strata.operators.dedup import distinct, keep_first, keep_first_placed
from strata.operators.keys import assign_keys, known_rows, max_key, new_rows, sent_if_small
from strata.operators.nulls import fill_numeric
from strata.operators.profile import write_profiled
from strata.operators.star import Dim, star_join
from strata.schemas import (CATEGORY_NATURAL_KEY, DIM_PRODUCT_COLUMNS, DIM_SELLER_COLUMNS,
                            FACT_COLUMNS, FACT_MEASURES, SRC_FILE, SRC_ROW)
from strata.session import materialize
from strata.sources.lake import write_parquet
from strata.sources.mart import Load, Mart

# ---- Fixed values (must equal the reference's rules) -------------------------
# Fill for missing category levels 3 and 4 (levels 1 and 2 stay null).
MISSING_LEVEL = "None"
# Path elements (0-based) that become category levels 1..4.
LEVEL_POSITIONS = (2, 3, 4, 5)
# -------------------------------------------------------------------------------

ORDER = [SRC_FILE, SRC_ROW]


def _first_per_key(silver: DataFrame, cols: list[str], key: list[str], strict: bool) -> DataFrame:
    if strict:
        return keep_first(silver.select(*cols, *ORDER), key, ORDER).select(*cols)
    # reference rule: full-row distinct, so one key with two attribute values gives two rows
    return distinct(silver.select(*cols))


def seller_rows(silver: DataFrame, strict: bool = True) -> DataFrame:
    return _first_per_key(silver, DIM_SELLER_COLUMNS, ["seller_id"], strict)


def brand_rows(silver: DataFrame, strict: bool = True) -> DataFrame:
    return _first_per_key(silver, ["brand_name", "is_top_brand"], ["brand_name"], strict)


def with_category_levels(df: DataFrame) -> DataFrame:
    p = F.col("primary_category_path")
    l1, l2, l3, l4 = (path_level(p, n) for n in LEVEL_POSITIONS)
    return df.select("*", l1.alias("category_l1_name"), l2.alias("category_l2_name"),
                     F.coalesce(l3, F.lit(MISSING_LEVEL)).alias("category_l3_name"),
                     F.coalesce(l4, F.lit(MISSING_LEVEL)).alias("category_l4_name"))


def category_rows(silver: DataFrame) -> DataFrame:
    """Distinct (category, path, name) with path levels; the natural key is the whole row."""
    return with_category_levels(distinct(silver.select(*CATEGORY_NATURAL_KEY)))


def product_rows(silver: DataFrame, strict: bool = True, placed: bool = False) -> DataFrame:
    """17 product columns, one row per product_id (first listing in file order). With ``placed`` (``silver`` is a
    written layer of listings with their file positions) they are found by a shuffle of ids and positions only, which runs at once."""
    src = silver.select(*[F.col(c) for c in DIM_PRODUCT_COLUMNS[2:]],
                        to_long("id").alias("product_id"),
                        to_long("sku", strict=False).alias("sku"), *ORDER)
    src = src.select(*DIM_PRODUCT_COLUMNS, *ORDER)
    if strict:
        first = keep_first_placed(src, ["product_id"], ORDER, SRC_ROW) if placed else keep_first(src, ["product_id"], ORDER)
        return first.select(*DIM_PRODUCT_COLUMNS)
    return src.select(*DIM_PRODUCT_COLUMNS).dropDuplicates(["product_id"])


# Each dimension: rows from silver, natural key, surrogate key (None: the natural key is kept).
DIMENSIONS = {
    "dim_seller": (seller_rows, ["seller_id"], None),
    "dim_category": (category_rows, CATEGORY_NATURAL_KEY, "category_id"),
    "dim_brand": (brand_rows, ["brand_name"], "brand_id"),
    "dim_product": (product_rows, ["product_id"], None),
}


def new_dimension_rows(rows: DataFrame, existing: DataFrame, key: list[str],
                       surrogate: str | None = None, null_safe: bool = True,
                       start: int | None = None) -> DataFrame:
    """Rows whose natural key is not in ``existing``; numbered after the largest
    existing surrogate key when ``surrogate`` is given (T11, ordered by the natural key)."""
    new = new_rows(rows, existing, key, null_safe=null_safe)
    if surrogate is None:
        return new
    if start is None:
        start = max_key(existing, surrogate)
    keyed = assign_keys(new, surrogate, key, start=start)
    return keyed.select(surrogate, *rows.columns)


def fact_rows(silver: DataFrame, dim_product: DataFrame, dim_seller: DataFrame,
              dim_category: DataFrame, dim_brand: DataFrame) -> DataFrame:
    """Silver listings resolved to dimension keys, numeric nulls set to 0.

    Dimensions are the whole current tables (so facts of known products resolve
    too). Those of few rows are sent to the facts. Category is joined on its full 3-column natural key. The reference's
    path-only join is not offered: it pairs each fact with every category row
    sharing the path.
    """
    cat_on = CATEGORY_NATURAL_KEY
    facts = silver.select(to_long("id").alias("product_id"), "seller_id", *CATEGORY_NATURAL_KEY,
                          "brand_name", *FACT_MEASURES)
    joined = star_join(facts, [
        # brands and categories turn text into numbers; products, mostly the most, come last
        Dim(sent_if_small(dim_brand.select("brand_name", "brand_id")), ["brand_name"], ["brand_id"], drop=["brand_name"]),
        Dim(sent_if_small(dim_category.select(*cat_on, "category_id")), cat_on, ["category_id"], drop=cat_on),
        Dim(sent_if_small(dim_seller.select("seller_id")), ["seller_id"], []),
        Dim(sent_if_small(dim_product.select("product_id")), ["product_id"], []),
    ])
    return fill_numeric(joined.select(*FACT_COLUMNS), 0)


def load_dimension(spark: SparkSession, rows: DataFrame, mart: Mart, table: str,
                   key: list[str], lake_path: str, surrogate: str | None = None,
                   null_safe: bool = True, load: Load | None = None) -> dict:
    """Write the new rows of one dimension, to the lake first; their profile, their folders in the
    mart (for the log of loads), the table with them, and the rows for this load's keys (``of_load``), which are
    all that its facts need. Without ``load`` they are appended at once."""
    existing = mart.read(table, schema=_dim_schema(rows, surrogate))
    # one row per key of this load; the rest of the dimension takes no part
    rows = materialize(rows, table)
    known = materialize(known_rows(existing, rows, key, rows.count(), null_safe), f"{table}-known")
    start = max_key(existing, surrogate) if surrogate else None
    new = new_dimension_rows(rows, known, key, surrogate=surrogate, null_safe=null_safe, start=start)
    # the lake write counts its rows as it goes (K5 without a second job)
    written = write_profiled(new, table, lambda df: write_parquet(df, lake_path))
    landed = spark.read.schema(new.schema).parquet(lake_path)
    staged = mart.log is not None and load is not None
    folders: list[str] = []
    if written["row_numbers"] > 0:  # P14: nothing new, nothing to append
        if staged:
            folders = mart.stage_load(landed, table, load)
        else:
            mart.append(landed, table)
    current = existing.unionByName(landed) if staged else mart.read(table, schema=_dim_schema(rows, surrogate))
    return {"table": current, "of_load": known.unionByName(landed), "profile": written, "rows": folders}


def _dim_schema(rows: DataFrame, surrogate: str | None):
    from pyspark.sql.types import LongType, StructField, StructType
    fields = list(rows.schema.fields)
    if surrogate:
        fields = [StructField(surrogate, LongType(), True)] + fields
    return StructType(fields)
