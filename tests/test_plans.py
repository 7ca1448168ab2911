"""Plan shape: column pruning reaches the Parquet scan, keep-first is one scan and one
exchange, and cleaned random Unicode text keeps none of what the rules remove."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.text import DELETED_CHARS, EMOJI_RANGES, clean_text
from strata.plans import silver as sv
from strata.plans import stand_in
from strata.sources.lake import read_listings


def _scan_schemas(df):
    out = []

    def walk(node):
        if "FileSourceScan" in node.getClass().getName():
            out.append(node.requiredSchema().simpleString())
        it = node.children().iterator()
        while it.hasNext():
            walk(it.next())
    walk(df._jdf.queryExecution().sparkPlan())
    return out


def test_silver_reads_only_used_leaves(spark, workdir):
    path = f"{workdir}/bronze"
    stand_in.listings(spark, "/root/testdata/sf0.001").drop("_src_file", "_src_row").write.parquet(path)
    s = sv.silver_products(read_listings(spark, path))
    schemas = _scan_schemas(s)
    main = max(schemas, key=len)
    assert "category:string" in main and "is_tikinow:boolean" in main
    # overridden or unused leaves are not read
    assert "is_trusted_store:boolean" not in main and "inventory_status" not in main
    assert "list_price" not in main
    assert len(schemas) == 1
    # one exchange, with at most one row per key and map task
    plan = s._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("== Initial Plan ==") if "== Initial Plan ==" in plan else 0:]
    assert plan.count("Exchange") == 1 and plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_fact_rows_plan_runs_no_job(spark):
    """Planning the star join reads nothing and funnels nothing into one partition."""
    from strata.operators.star import Dim, star_join
    facts = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("b"))
    dim = spark.range(7).select(F.col("id").alias("b"), (F.col("id") * 10).alias("sk"))
    spark.sparkContext.setJobGroup("star", "star")
    out = star_join(facts, [Dim(dim, ["b"], ["sk"])])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("star")
    assert "SinglePartition" not in plan and "GlobalLimit" not in plan
    assert out.count() == 1000


ALPHABET = st.sampled_from(
    list("abcXYZ019 .,/:") + ["http", "https://a.b/c?d=1", "<", ">", "<b>", "</i>", "\n", "\t", "\r",
                             " ", "　", " ", " ", "\x85", "\x1c", " ",
                             "(", ")", "*", "!", "@", "#", "$", "%", "^", "😀", "🚀", "✂", "漢",
                             "한", "", "Đ", "Ố", "é", "ß"])


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=25).map("".join), min_size=40, max_size=80))
def test_clean_text_property(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", clean_text("t").alias("c")).collect()}
    parts = {r.i: r.c for r in df.select("i", clean_text(F.regexp_replace("t", "[<>]|http", "")).alias("c")).collect()}
    for i, t in enumerate(texts):
        gone = lambda c: c in DELETED_CHARS or c in "\n\t\r" or any(a <= ord(c) <= b for a, b in EMOJI_RANGES)
        assert not any(map(gone, got[i])) and not (got[i].startswith(" ") and t.startswith("a"))
        # without tags and URLs each character is judged by itself
        plain = t.replace("<", "").replace(">", "").replace("http", "")
        if "http" not in plain:
            line = plain.lower().strip()
            assert parts[i] == "".join(" " if c in "\n\t\r" else "" if gone(c) else c for c in line), repr(t)


def test_partitioned_landing_keeps_file_order(spark, workdir):
    """Listings landed as category folders by many tasks give the same silver rows
    (same keep-first survivors) as the stand-in read directly; same for reviews."""
    from strata.plans import catalog
    from strata.sources.lake import read_reviews
    from strata.schemas import REVIEW
    d = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.shuffle.partitions", "5")  # several files per category
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        listing_dir, review_dir = catalog.land_stand_in(spark, d, f"{workdir}/landing")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    import glob
    assert len(glob.glob(f"{review_dir}/part-*.csv")) > 1
    assert max(len(glob.glob(f"{c}/*.parquet")) for c in glob.glob(f"{listing_dir}/category=*")) > 1
    landed = sv.silver_products(read_listings(spark, listing_dir, partition_column="category"),
                                provenance=False)
    direct = catalog.silver_products_q(spark, d)
    assert landed.exceptAll(direct).count() == 0 and direct.exceptAll(landed).count() == 0
    rl = sv.silver_reviews(read_reviews(spark, review_dir, REVIEW))
    rd = catalog.silver_reviews_q(spark, d)
    assert rl.exceptAll(rd).count() == 0 and rd.exceptAll(rl).count() == 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.sampled_from(["a", "b", None]),
                          st.integers(0, 99)), min_size=1, max_size=120),
       st.integers(1, 7))
def test_keep_first_property(spark, rows, parts):
    """keep_first == plain Python 'smallest ordinal per key' for any partitioning."""
    from strata.operators.dedup import keep_first
    data = [(k, j, i * 1000 + v, f"r{i}") for i, (k, j, v) in enumerate(rows)]  # unique ordinals
    df = spark.createDataFrame(data, "k int, j string, o long, v string").repartition(parts)
    got = sorted((r.v for r in keep_first(df, ["k", "j"], ["o"]).collect()))
    best = {}
    for k, j, o, v in data:
        if (k, j) not in best or o < best[(k, j)][0]:
            best[(k, j)] = (o, v)
    assert got == sorted(v for _, v in best.values())


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from(["x", None])),
                max_size=40),
       st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from(["x", None])),
                max_size=20))
def test_new_rows_property(spark, incoming, existing):
    """null-safe: a key is new unless an equal key (null == null) exists;
    reference rule: any key with a null part is always new."""
    from strata.operators.keys import new_rows
    inc = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(incoming)], "a int, b string, i int")
    ex = spark.createDataFrame(existing, "a int, b string")
    ex_set = set(existing)
    got_safe = sorted(r.i for r in new_rows(inc, ex, ["a", "b"]).collect())
    got_ref = sorted(r.i for r in new_rows(inc, ex, ["a", "b"], null_safe=False).collect())
    assert got_safe == [i for i, key in enumerate(incoming) if key not in ex_set]
    assert got_ref == [i for i, key in enumerate(incoming) if None in key or key not in ex_set]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet="abcxyz", min_size=1, max_size=6), min_size=1, max_size=80, unique=True),
       st.integers(1, 9), st.integers(0, 1000))
def test_assign_keys_property(spark, names, parts, start):
    """Keys are start+1.. in natural-key order, whatever the input partitioning."""
    from strata.operators.keys import assign_keys
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(parts)
    got = {r.name: r.sk for r in assign_keys(df, "sk", ["name"], start=start).collect()}
    assert got == {n: start + i + 1 for i, n in enumerate(sorted(names))}


SMALL = "/root/testdata/sf0.001"


def _initial_plan(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("== Initial Plan ==") if "== Initial Plan ==" in plan else 0:]


def _no_broadcast_by_size(spark, make):
    """The plan as it is where tables are too large for Spark to broadcast them by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return _initial_plan(make())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_stand_in_silver_shuffles_lines_and_parts_only(spark):
    from strata.plans import catalog
    plan = _no_broadcast_by_size(spark, lambda: catalog.silver_products_q(spark, SMALL))
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("BroadcastExchange") == 1


def test_landing_is_ordered_before_it_is_widened(spark):
    from strata.plans import catalog
    plan = _initial_plan(catalog.in_file_order(stand_in.listing_lines(spark, SMALL)))
    above, below = plan.split("Exchange rangepartitioning")
    assert "url_path" in above and "url_path" not in below and "Sort" in above


def test_many_suppliers_are_not_sent(spark, monkeypatch):
    """Above the bound suppliers meet the lines in a shuffle, before these are widened; the rows are the same."""
    from strata.operators import keys
    from strata.plans import catalog
    sent = catalog.silver_products_q(spark, SMALL)
    monkeypatch.setattr(keys, "SEND_KEYS", 1)
    plan = _no_broadcast_by_size(spark, lambda: catalog.silver_products_q(spark, SMALL))
    assert "BroadcastExchange" not in plan and plan.count("Exchange hashpartitioning") == 4
    shuffled = catalog.silver_products_q(spark, SMALL)
    assert sent.exceptAll(shuffled).count() == 0 and shuffled.exceptAll(sent).count() == 0


def test_facts_are_not_shuffled_for_small_dimensions(spark):
    from strata.plans import catalog
    plan = _no_broadcast_by_size(spark, lambda: catalog.fact_star_join(spark, SMALL))
    assert "SortMergeJoin" not in plan and plan.count("BroadcastExchange") == 4


def test_landed_part_holds_its_categories_in_order(spark, workdir):
    """A part landing equals that part of the whole landing, file order included."""
    from strata.plans import catalog
    some = F.col("category").isin(catalog.LOAD1_FILES)
    whole, _ = catalog.land_stand_in(spark, SMALL, f"{workdir}/landing")
    part = catalog._land_part(spark, SMALL, some, f"{workdir}/part")
    rows = []
    for path in (whole, part):
        at = spark.read.parquet(path).where(some).select("category", "id", "seller_id", "price", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("r"))
        rows.append([r[:4] for r in sorted(at.collect(), key=lambda r: (r.category, r.f, r.r))])
    assert rows[0] == rows[1] and len(rows[0]) > 1000
    import glob
    assert glob.glob(f"{part}/category=*/*.zstd.parquet") and not glob.glob(f"{part}/category=*/*.snappy.parquet")


def test_scans_are_split_for_rows_that_widen(spark):
    from strata.session import DEFAULTS
    assert DEFAULTS["spark.sql.files.maxPartitionBytes"] == spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"


def test_silver_layer_is_written_without_another_shuffle(spark, workdir, monkeypatch):
    """The dedup is the layer's only shuffle, of columns that nothing else gives, and each task's categories come one after another."""
    from strata.plans import catalog, medallion
    from strata.sources.lake import write_parquet
    from strata.sources.mart import Load
    plans = []
    monkeypatch.setattr(medallion, "write_parquet", lambda df, path, partition_by=None, rebalance=True: (
        plans.append((_initial_plan(df), rebalance)), write_parquet(df, path, partition_by=partition_by, rebalance=rebalance)))
    listing_dir, _ = catalog.land_stand_in(spark, SMALL, f"{workdir}/landing")
    load, own = Load.of_run("x"), medallion.Lake(f"{workdir}/lake")
    out, done = medallion.silver_products(medallion.bronze_products(spark, listing_dir, own, load, partition_column="category")[0], own, load)
    (_, _), (plan, rebalance) = plans
    assert not rebalance and plan.count("Exchange") == 1
    below = plan.split("Exchange")[1]
    assert "list_price" not in below.split("Scan")[0] and "is_official_store" not in below.split("Scan")[0]
    assert out.count() == done["row_numbers"] > 1000
    assert out.where("list_price <=> price - discount AND inventory_status <=> availability").count() == done["row_numbers"]


def test_listings_are_landed_once(spark, workdir, monkeypatch):
    """Queries with several loads land every listing once, each in its part; those without a category belong to no load but to the whole."""
    from strata.plans import catalog
    landed = []
    real, lines = catalog.land_listings, stand_in.listing_lines
    monkeypatch.setattr(catalog, "land_listings", lambda lines, path: landed.append(path) or real(lines, path))
    holed = F.when(F.col("l_orderkey") % 7 != 0, F.col("category"))
    monkeypatch.setattr(catalog, "listing_lines", lambda spark, d: lines(spark, d).withColumn("category", holed))
    _, whole, parts, _, _, _ = catalog._landed_parts(spark, SMALL, "landed_once")
    assert landed[1:] == parts and len(landed) == 3
    n, uncategorised = lines(spark, SMALL).count(), lines(spark, SMALL).where("l_orderkey % 7 = 0").count()
    got = read_listings(spark, whole, partition_column="category")
    assert got.count() == n and got.where("_src_file IS NULL").count() == uncategorised > 0
    assert sum(spark.read.parquet(p).count() for p in parts) == n - uncategorised


def test_shuffle_files_go_with_their_job(spark):
    from strata.session import DEFAULTS
    k = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(k) == DEFAULTS[k] == "true"
    df = spark.range(2000).repartition(7).groupBy("id").count()
    assert len(df.collect()) == len(df.collect()) == 2000  # the files are made again
