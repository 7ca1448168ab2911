"""Command line: run the medallion jobs on the current Spark session.

    spark-submit strata/__main__.py run --listings PATH --reviews PATH --lake ROOT \\
        --load-id NAME (--mart-parquet ROOT | --mart-jdbc URL) [--partition-column category]
    spark-submit strata/__main__.py incremental --landing PATH [--what reviews] --lake ROOT \\
        --checkpoint PATH (--mart-parquet ROOT | --mart-jdbc URL)

(``python -m strata ...`` does the same with a local session; ship the package
with ``--py-files`` on a cluster.)

JDBC credentials come from the Spark configuration (``spark.strata.mart.user``,
``spark.strata.mart.password``, ``spark.strata.mart.driver``), never from code.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _mart(spark: SparkSession, args):
    from strata.sources.mart import ParquetMart, StagedJdbcMart
    if args.mart_parquet:
        return ParquetMart(spark, args.mart_parquet)
    conf = spark.sparkContext.getConf()
    props = {k: conf.get(f"spark.strata.mart.{k}") for k in ("user", "password", "driver")
             if conf.get(f"spark.strata.mart.{k}", None)}
    split = dict(x.split(":") for x in args.mart_split)
    return StagedJdbcMart(spark, args.mart_jdbc, props, partition_columns=split)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="strata")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("run", "incremental"):
        s = sub.add_parser(name)
        s.add_argument("--lake", required=True)
        m = s.add_mutually_exclusive_group(required=True)
        m.add_argument("--mart-parquet")
        m.add_argument("--mart-jdbc")
        s.add_argument("--mart-split", action="append", default=[], metavar="TABLE:COLUMN",
                       help="read a JDBC table in parallel ranges of a column")
        s.add_argument("--partition-column")
    sub.choices["run"].add_argument("--listings", required=True)
    sub.choices["run"].add_argument("--reviews", required=True)
    sub.choices["run"].add_argument("--load-id", required=True, help="name of this load; loading it again replaces its facts")
    sub.choices["incremental"].add_argument("--landing", required=True)
    sub.choices["incremental"].add_argument("--what", choices=("listings", "reviews"), default="listings")
    sub.choices["incremental"].add_argument("--checkpoint", required=True)
    args = p.parse_args(argv)

    from strata.plans.medallion import Lake, run
    from strata.session import drop_scratch, ensure_defaults
    spark = ensure_defaults(SparkSession.builder.getOrCreate())
    mart = _mart(spark, args)
    if args.cmd == "run":
        profile = run(spark, args.listings, args.reviews, Lake(args.lake), mart, args.load_id,
                      partition_column=args.partition_column)
        for r in profile.collect():  # one row per job
            print(f"{r.table_name}\t{r.row_numbers}\t{r.column_numbers}")
    elif args.what == "listings":
        from strata.streaming.incremental import run_available_now
        run_available_now(spark, args.landing, Lake(args.lake), mart, args.checkpoint,
                          partition_column=args.partition_column)
    else:
        from strata.streaming.incremental import run_reviews_available_now
        run_reviews_available_now(spark, args.landing, Lake(args.lake), mart, args.checkpoint)
    drop_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
