"""Landed API pages -> rows, cut at the first bad page per category."""

import json

from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.schemas import LANDED_PAGE
from strata.sources.pages import landed_rows

ITEM = StructType([StructField("id", LongType()), StructField("name", StringType())])


def _body(ids):
    return json.dumps({"data": [{"id": i, "name": f"p{i}"} for i in ids]})


def test_cut_at_first_bad_page(spark):
    pages = spark.createDataFrame([
        # a: non-200 page in the middle -> pages 1, 2 only
        ("a", 1, 200, _body([1, 2])), ("a", 2, 200, _body([3])), ("a", 3, 500, _body([4])),
        ("a", 4, 200, _body([5])),
        # b: empty page then a full one -> the full one is dropped
        ("b", 1, 200, _body([10])), ("b", 2, 200, _body([])), ("b", 3, 200, _body([11])),
        # c: first page bad -> nothing
        ("c", 1, 404, _body([20])), ("c", 2, 200, _body([21])),
        # e: a page whose only item is null still counts as non-empty
        ("e", 1, 200, json.dumps({"data": [None]})), ("e", 2, 200, _body([40])),
        # no category: a category of its own
        (None, 1, 200, _body([50])), (None, 2, 500, _body([51])),
        # d: all good
        ("d", 2, 200, _body([31])), ("d", 1, 200, _body([30])),
    ], LANDED_PAGE)
    rows = landed_rows(pages, ITEM)
    assert [r.id for r in rows.where("category is null").collect()] == [50]
    got = sorted((r.category, r.page, r.item_pos, r.id) for r in rows.where("category is not null").collect())
    got = [g for g in got if g[0] != "e"] + sorted(g[:3] for g in got if g[0] == "e")
    assert got == [("a", 1, 0, 1), ("a", 1, 1, 2), ("a", 2, 0, 3), ("b", 1, 0, 10),
                   ("d", 1, 0, 30), ("d", 2, 0, 31), ("e", 1, 0), ("e", 2, 0)]
