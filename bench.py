"""Headline-query timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion through the ``noop`` sink (full evaluation, no
result transfer to the driver). A short warm-up on the smallest scale runs
first so JVM start and code generation are not charged to the first query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "silver_products", "silver_reviews", "fact_star_join", "dim_category", "dim_brand",
    "dedup_keep_first", "clean_text_documents", "clean_text_pages", "page_landing",
    "new_keys_composite", "price_override", "table_profile",
]


def from_landed_files(spark, sf_dir: str) -> dict[str, float]:
    """The stand-in listings landed once, then each layer from files, as a load runs."""
    from strata.plans import catalog, medallion
    from strata.session import scratch_path
    from strata.sources.mart import Load, ParquetMart
    root, load = scratch_path(spark, "bench"), Load.of_run("bench")
    lake, mart, times = medallion.Lake(f"{root}/lake"), ParquetMart(spark, f"{root}/mart"), {}

    def timed(name, fn, *args, **more):
        t0 = time.perf_counter()
        out = fn(*args, **more)
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    listings, reviews = timed("landing", catalog.land_stand_in, spark, sf_dir, f"{root}/landing")
    bronze, _ = timed("bronze_landed", medallion.bronze_products, spark, listings, lake, load, partition_column="category")
    silver, _ = timed("silver_landed", medallion.silver_products, bronze, lake, load)
    timed("gold_landed", medallion.load_gold, spark, silver, lake, mart, load)
    timed("gold_again", medallion.load_gold, spark, silver, lake, mart, load.again())
    timed("reviews_landed", medallion.load_reviews, spark, reviews, lake, mart, Load.of_run("reviews"))
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from strata.plans import catalog
    from strata.session import build_session, drop_scratch
    spark = build_session(f"local[{cpus}]", app="strata-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm):
        for name in ("silver_products", "clean_text_documents"):
            catalog.QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    times |= from_landed_files(spark, sf_dir)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
