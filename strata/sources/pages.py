"""Landed listing-API pages -> listing rows.

The crawler pages through a category until the first page that is not HTTP 200
or has an empty ``data`` array, and keeps the pages before it. Given the stored
responses (category, page, status, body), the same cut is a per-category
minimum over the bad pages -- an aggregation with map-side combine, so a
category with most of the pages is no hot task -- joined back, then an explode
of each kept page's ``data`` array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType


def landed_rows(pages: DataFrame, item_schema: StructType, ok_status: int = 200) -> DataFrame:
    """One row per item of every page before the category's first bad page.

    Output: category, page, item_pos (position on the page), then the item fields.
    """
    body = StructType([StructField("data", ArrayType(item_schema))])
    # the cut only needs the length of ``data`` (as the crawler's len(data) == 0):
    # counted on the JSON text, without converting the items to structs
    empty = F.coalesce(F.json_array_length(F.get_json_object("body", "$.data")), F.lit(0)) == 0
    bad = (F.col("status") != F.lit(ok_status)) | empty
    stops = pages.groupBy("category").agg(F.min(F.when(bad, F.col("page"))).alias("_stop"))
    parsed = pages.select("category", "page",
                          F.from_json("body", body).getField("data").alias("data"))
    stops = stops.withColumnRenamed("category", "_category")
    kept = (parsed.join(stops, F.col("category").eqNullSafe(F.col("_category")))
                  .where(F.col("_stop").isNull() | (F.col("page") < F.col("_stop"))))
    return (kept.select("category", "page", F.posexplode("data").alias("item_pos", "item"))
                .select("category", "page", "item_pos", "item.*"))
