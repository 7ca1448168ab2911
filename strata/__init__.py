"""strata: a Spark-native medallion warehouse (bronze -> silver -> gold star schema).

Every function takes and returns DataFrames or Columns; nothing is collected to
the driver except single scalars (a largest key, a row-count bound check), one
row per file (names and schemas of landed files) and one per committed load.
"""

from strata.functions.columns import array_length, first_of, flag, path_level, to_long
from strata.functions.text import clean_text
from strata.operators.dedup import dedup_any, distinct, keep_first, union_all
from strata.operators.keys import assign_keys, known_rows, new_rows
from strata.operators.nested import flatten
from strata.operators.nulls import fill, fill_numeric, require
from strata.operators.profile import observed, profile
from strata.operators.star import Dim, star_join
from strata.plans.gold import (brand_rows, category_rows, fact_rows, load_dimension,
                               new_dimension_rows, product_rows, seller_rows)
from strata.plans.medallion import Lake, load_gold, read_layer, run
from strata.plans.silver import silver_products, silver_reviews
from strata.session import build_session, drop_scratch, ensure_defaults, materialize
from strata.sources.lake import csv_records, read_csv, read_listings, read_reviews, require_schema, write_csv, write_parquet
from strata.sources.load_log import LoadLog
from strata.sources.mart import JdbcMart, Load, Mart, ParquetMart, StagedJdbcMart
from strata.sources.pages import landed_rows

__all__ = [
    "array_length", "first_of", "flag", "path_level", "to_long", "clean_text",
    "dedup_any", "distinct", "keep_first", "union_all", "assign_keys", "known_rows", "new_rows",
    "flatten", "fill", "fill_numeric", "require", "observed", "profile",
    "Dim", "star_join",
    "brand_rows", "category_rows", "fact_rows", "load_dimension", "new_dimension_rows",
    "product_rows", "seller_rows", "Lake", "load_gold", "read_layer", "run", "silver_products", "silver_reviews",
    "build_session", "drop_scratch", "ensure_defaults", "materialize",
    "csv_records", "read_csv", "read_listings", "read_reviews", "require_schema", "write_csv", "write_parquet",
    "LoadLog", "JdbcMart", "Load", "Mart", "ParquetMart", "StagedJdbcMart", "landed_rows",
]
