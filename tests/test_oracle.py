"""Every registered query of the library itself against its DuckDB oracle (sf0.001; the driver runs sf0.01)."""

import os

import pytest

SF = os.environ.get("STRATA_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_queries_match_oracle(spark):
    import oracle_check
    from strata.plans import catalog
    res = oracle_check.compare(spark, SF, names=list(catalog.QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if not v.startswith("ok")}
    assert not bad, bad


def test_every_query_has_oracle():
    import __spark_entry__ as e
    from strata.plans import catalog
    assert set(catalog.QUERIES) <= set(e.oracle_sql()) <= set(e.queries())
