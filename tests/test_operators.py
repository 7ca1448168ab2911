"""Table operators: dedup (G2-G5), null policy (P11-P13), new keys (J1-J2), keys (T11), star join."""

from pyspark.sql import functions as F

from strata.operators.dedup import dedup_any, keep_first, union_all
from strata.operators.keys import assign_keys, new_rows
from strata.operators.nulls import fill, fill_numeric, require
from strata.operators.profile import profile
from strata.operators.star import Dim, star_join


def test_keep_first_null_keys_form_one_group(spark):
    df = spark.createDataFrame(
        [(1, "a", 3, "x3"), (1, "a", 1, "x1"), (None, "a", 5, "n5"), (None, "a", 2, "n2"),
         (2, None, 9, "b9"), (2, None, 4, "b4")], "k int, j string, o int, v string")
    got = sorted(((r.k, r.j, r.v) for r in keep_first(df, ["k", "j"], ["o"]).collect()), key=str)
    assert got == sorted([(1, "a", "x1"), (None, "a", "n2"), (2, None, "b4")], key=str)
    assert keep_first(df, ["k", "j"], ["o"]).columns == df.columns


def test_keep_first_hot_key_across_partitions(spark):
    # one key holds most rows, spread over many input partitions
    df = spark.range(0, 20000, numPartitions=16).select(
        F.when(F.col("id") % 10 < 7, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
        (F.lit(100000) - F.col("id")).alias("o"), F.col("id").alias("v"))
    got = {r.k: r.v for r in keep_first(df, ["k"], ["o"]).collect()}
    expect = {}
    for i in range(20000):
        k = 0 if i % 10 < 7 else i % 50
        expect[k] = max(expect.get(k, -1), i)  # smallest o = largest id
    assert got == expect


def test_keep_first_composite_order(spark):
    df = spark.createDataFrame([(1, "f2", 0, "a"), (1, "f1", 9, "b"), (1, "f1", 3, "c")],
                               "k int, f string, r int, v string")
    assert keep_first(df, ["k"], ["f", "r"]).first().v == "c"


def test_keep_first_ties_leave_one_row(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 0, "b"), (2, 0, "c"), (2, 0, "c")], "k int, o int, v string")
    assert sorted(r.k for r in keep_first(df, ["k"], ["o"]).collect()) == [1, 2]


def test_dedup_any_and_union(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    assert dedup_any(a, ["k"]).count() == 1
    b = spark.createDataFrame([(2,)], "k int")
    u = union_all([a, b])
    assert u.columns == ["k", "v"]
    assert sorted((r.k, r.v) for r in u.collect()) == [(1, "x"), (1, "y"), (2, None)]


def test_null_policy(spark):
    df = spark.createDataFrame([(None, None, None, None), (1, 2.5, "s", True)],
                               "a int, b double, c string, d boolean")
    r = fill(df, {"a": 0, "c": "none"}).orderBy("b").first()
    assert (r.a, r.b, r.c) == (0, None, "none")
    n = fill_numeric(df, 0).orderBy(F.col("c").asc_nulls_first()).first()
    assert (n.a, n.b, n.c, n.d) == (0, 0.0, None, None)
    assert require(df, ["a", "c"]).count() == 1
    assert fill(df, {"a": "text"}).filter("a is null").count() == 1  # type mismatch: skipped


def test_new_rows_null_safe_and_reference_rule(spark):
    inc = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (3, None)], "k int, v string")
    ex = spark.createDataFrame([(1,), (None,)], "k int")
    assert sorted(r.v or "" for r in new_rows(inc, ex, ["k"]).collect()) == ["", "b"]
    assert sorted(r.v or "" for r in new_rows(inc, ex, ["k"], null_safe=False).collect()) == ["", "b", "n"]
    ex2 = spark.createDataFrame([(3, None)], "k int, v string")
    assert sorted(r.k for r in new_rows(inc, ex2, ["k", "v"]).collect() if r.k) == [1, 2]


def test_assign_keys_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        F.format_string("n%05d", (F.col("id") * 7919) % 5000).alias("name"))
    keyed = assign_keys(df, "sk", ["name"], start=100)
    rows = sorted((r.name, r.sk) for r in keyed.collect())
    assert [sk for _, sk in rows] == list(range(101, 5101))


def test_star_join_drops_unknown_and_does_not_fan_out(spark):
    facts = spark.createDataFrame([(1, "a", 10.0), (2, "b", 20.0), (3, None, 30.0)],
                                  "product_id int, brand_name string, price double")
    dim = spark.createDataFrame([("a", 100), ("b", 200)], "brand_name string, brand_id int")
    out = star_join(facts, [Dim(dim, ["brand_name"], ["brand_id"], drop=["brand_name"])])
    assert sorted((r.product_id, r.brand_id) for r in out.collect()) == [(1, 100), (2, 200)]


def test_profile(spark):
    df = spark.createDataFrame([(1, 2), (3, 4)], "a int, b int")
    r = profile(df, "t").first()
    assert (r.table_name, r.row_numbers, r.column_numbers) == ("t", 2, 2)


def test_star_join_hot_key_without_broadcast(spark):
    """A third of the facts on one seller, with broadcasts off and on:
    the shuffle path (AQE may split the hot partition) gives the same rows."""
    facts = spark.range(0, 30000, numPartitions=12).select(
        F.col("id").alias("product_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 100).cast("long").alias("seller_id"),
        (F.col("id") % 11).cast("string").alias("brand_name"))
    sellers = spark.range(0, 100).select(F.col("id").alias("seller_id"))
    brands = spark.range(0, 11).select(F.col("id").cast("string").alias("brand_name"),
                                       (F.col("id") + 1000).alias("brand_id"))
    dims = [Dim(sellers, ["seller_id"], []), Dim(brands, ["brand_name"], ["brand_id"], drop=["brand_name"])]
    shuffled = star_join(facts, dims)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()
        rows = sorted(shuffled.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == 30000 and rows == sorted(star_join(facts, dims).collect())
    # id % 3 == 0 (10000 rows), plus the 200 ids with id % 100 == 7 that are not multiples of 3
    assert shuffled.where("seller_id = 7").count() == 10000 + 200


def test_strict_cast_fails_on_malformed_text(spark):
    import pytest
    from pyspark.errors import PySparkException
    from strata.functions.columns import to_long
    df = spark.createDataFrame([("12",), ("x1",)], "s string")
    with pytest.raises(Exception) as e:
        df.select(to_long("s", strict=True)).collect()
    assert isinstance(e.value, (PySparkException, Exception)) and "CAST_INVALID_INPUT" in str(e.value)


def test_known_rows_leave_the_dimension_where_it_is(spark, workdir):
    """The keys of a load go to the dimension: no exchange above its scan; the same rows as by a shuffle join."""
    from strata.operators import keys
    spark.range(1000).selectExpr("CASE WHEN id = 7 THEN NULL ELSE concat('n', id) END AS name", "id % 3 AS top", "id AS brand_id").write.parquet(f"{workdir}/dim")
    dim = spark.read.parquet(f"{workdir}/dim")
    load = spark.createDataFrame([("n5",), (None,), ("new",)], "name string")
    sent = keys.known_rows(dim, load, ["name"], 3)
    plan = sent._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    moved = keys.known_rows(dim, load, ["name"], keys.SEND_KEYS + 1)
    assert sorted(r.brand_id for r in sent.collect()) == sorted(r.brand_id for r in moved.collect()) == [5, 7]
    assert [r.brand_id for r in keys.known_rows(dim, load, ["name"], 3, null_safe=False).collect()] == [5]


def test_keep_first_placed_shuffles_keys_only(spark, workdir, monkeypatch):
    """The same rows as keep_first, null keys included, and no exchange above wide rows; whole rows are shuffled above the bound or where places are shared."""
    from pyspark.sql import functions as F
    from strata.operators import dedup
    from strata.sources.lake import file_position
    path = f"{workdir}/rows"
    (spark.range(0, 100_000, 1, 3).select(F.when(F.col("id") % 11 != 0, F.col("id") * 7919 % 4001).alias("k"), (F.col("id") % 3).cast("string").alias("j"), F.col("id").alias("wide"))
        .write.parquet(path))
    df = spark.read.parquet(path).select("*", file_position().alias("at"))
    keys, rows = ["k", "j"], lambda x: sorted((str(r.k), r.j, r.wide) for r in x.collect())
    want = rows(dedup.keep_first(df, keys, ["at"]))

    def plan_of(x):
        plan = x._jdf.queryExecution().executedPlan().toString()
        return plan[plan.index("== Initial Plan ==") if "== Initial Plan ==" in plan else 0:]
    got = dedup.keep_first_placed(df, keys, ["at"], "at")
    plan = plan_of(got)
    assert plan.count("Exchange") == plan.count("BroadcastExchange") == 1 and "Window" not in plan
    assert got.columns == df.columns and rows(got) == want and len(want) > 12_000
    twice = dedup.keep_first_placed(df.union(df), keys, ["at"], "at")
    assert "Window" in plan_of(twice) and rows(twice) == want
    nowhere = df.withColumn("at", F.when(F.col("k").isNotNull(), F.col("at")))
    assert len(rows(dedup.keep_first_placed(nowhere, keys, ["at"], "at"))) == len(want)
    monkeypatch.setattr(dedup, "SEND_BITMAPS", 1)
    many = dedup.keep_first_placed(df, keys, ["at"], "at")
    assert "Window" in plan_of(many) and rows(many) == want
