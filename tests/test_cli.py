"""Command line: a full run over landed files prints one profile line per job."""

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_cli_run(spark, workdir, capsys):
    from strata.__main__ import main
    from strata.plans import catalog
    listings, reviews = catalog.land_stand_in(spark, SF, f"{workdir}/landing")
    assert main(["run", "--listings", listings, "--reviews", reviews, "--lake", f"{workdir}/lake", "--load-id", "day1",
                 "--mart-parquet", f"{workdir}/mart", "--partition-column", "category"]) == 0
    lines = dict(line.split("\t", 1) for line in capsys.readouterr().out.strip().splitlines())
    assert set(lines) == {"bronze_product", "silver_product", "dim_seller", "dim_category", "dim_brand", "dim_product",
                          "fact", "bronze_review", "silver_review", "review"}
    # same fact rows as the registered flagship query on the same tables
    assert int(lines["fact"].split("\t")[0]) == catalog.fact_star_join(spark, SF).count()
