"""DuckDB SQL stating the expected result of each registered query.

Tables are the driver's views (region ... conversations). The SQL states the
semantics directly (window ``QUALIFY`` for keep-first, ``NOT EXISTS`` with
``IS NOT DISTINCT FROM`` for null-safe new keys, ...), independently of the Spark
plans; only fixed values (character classes, fill texts) are shared.
"""

from __future__ import annotations

from strata.functions.text import EMOJI_CLASS, WS_CLASS
from strata.plans.catalog import BRANCHES, DRIVER_TABLES, LOAD1_FILES
from strata.plans.silver import UNKNOWN_ORIGIN
from strata.plans.stand_in import CATEGORY_USERS, PAGE_SPAN

# Column counts of the driver tables (FIXTURES.md section 6).
DRIVER_COLUMNS = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6,
                  "lineitem": 11, "events": 6, "documents": 5, "embeddings": 3, "pages": 3,
                  "benchmark": 2, "labels": 3, "conversations": 4}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean_sql(x: str) -> str:
    s = f"lower(coalesce({x}, ''))"
    s = f"regexp_replace({s}, '^[{WS_CLASS}]+|[{WS_CLASS}]+$', '', 'g')"
    s = f"regexp_replace({s}, '[\\n\\t\\r]', ' ', 'g')"
    s = f"regexp_replace({s}, '[{EMOJI_CLASS}]+', '', 'g')"
    s = f"regexp_replace({s}, 'http[^{WS_CLASS}]+', '', 'g')"
    s = f"regexp_replace({s}, '<.*?>', '', 'g')"
    return f"regexp_replace({s}, '[()*!@#$%^]', '', 'g')"


def decorate_sql(t: str, k: str) -> str:
    ks = f"CAST({k} AS VARCHAR)"
    return (f"CASE ({k}) % 6 "
            f"WHEN 0 THEN concat('  <b>', {t}, {_q('</b> ' + chr(0x1F600) + ' ')}) "
            f"WHEN 1 THEN concat({t}, ' see http://shop.example.com/p?id=', {ks}, ' now') "
            f"WHEN 2 THEN concat({_q(chr(0xA0) + chr(9) + 'ĐÁNH GIÁ TỐT: ')}, {t}, {_q('(ok)*!' + chr(0x3000))}) "
            f"WHEN 3 THEN concat('<a href=\"http://x.example/', {ks}, '\">', {t}, '</a> z') "
            f"WHEN 4 THEN concat({t}, {_q(' 漢字 ✂ 100% #1 @me' + chr(13) + chr(10) + 'line' + chr(0x2028) + '<i' + chr(0x2028) + '>x</i>')}) "
            f"ELSE {t} END")


def lenient_long(x: str) -> str:
    return f"coalesce(TRY_CAST({x} AS BIGINT), CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS BIGINT))"


def levels(p: str) -> str:
    return (f"string_split({p}, '/')[3] AS category_l1_name, string_split({p}, '/')[4] AS category_l2_name, "
            f"coalesce(string_split({p}, '/')[5], 'None') AS category_l3_name, "
            f"coalesce(string_split({p}, '/')[6], 'None') AS category_l4_name")


_NO_META = "l_orderkey % 11 = 0 OR p_partkey % 7 = 0"
_SELLER_TYPE = ("CASE WHEN l_orderkey % 50 = 7 THEN 'MARKETPLACE' WHEN l_suppkey % 4 = 0 THEN 'OFFICIAL_STORE' "
                "WHEN l_suppkey % 4 = 1 THEN 'TRUSTED_STORE' WHEN l_suppkey % 4 = 2 THEN 'MARKETPLACE' END")
_PATH = ("CASE WHEN p_partkey % 17 = 0 THEN NULL "
         "WHEN p_partkey % 4 = 0 THEN concat('1/2/', p_type) "
         "WHEN p_partkey % 4 = 1 THEN concat('1/2/', p_type, '/', p_brand) "
         "WHEN p_partkey % 4 = 2 THEN concat('1/2/', p_type, '/', p_brand, '/s', CAST(p_size AS VARCHAR)) "
         "ELSE concat('1/2/', p_type, '/', p_brand, '/s', CAST(p_size AS VARCHAR), '/x', "
         "CAST(p_partkey % 3 AS VARCHAR)) END")
_AVAIL = "CAST(CASE WHEN l_orderkey % 10 = 3 THEN 0 ELSE l_linenumber END AS INTEGER)"
_DISC = "CAST(floor(l_extendedprice * l_discount) AS BIGINT)"

SILVER_COLS = """id, sku, name, url_key, url_path, availability, is_imported, is_authentic, tiki_verified,
 is_tikinow, is_tikipro, is_ad, inventory_status, is_visible, origin, freegift_items, shippable,
 seller_id, seller_type, is_official_store, is_trusted_store, primary_category_path, category,
 primary_category_name, brand_name, is_top_brand, is_flash_deal, is_freeship_xtra, is_gift_available,
 bundle_deal, price, list_price, discount, discount_rate, product_rating, rating_average, review_count,
 favourite_count, original_price, all_time_quantity_sold, number_of_reviews, search_rank"""

# Flat listing rows before dedup, then silver = first per (file, 5 identity columns).
SILVER_CTES = f"""
lf AS (
 SELECT l_partkey AS id,
  CASE WHEN l_linenumber = 7 THEN concat(CAST(l_partkey AS VARCHAR), '.0')
       WHEN l_linenumber = 6 AND l_orderkey % 5 = 0 THEN concat('SKU', CAST(l_partkey AS VARCHAR))
       ELSE CAST(l_partkey AS VARCHAR) END AS sku,
  p_name AS name, replace(p_name, ' ', '-') AS url_key,
  concat(replace(p_name, ' ', '-'), '-p', CAST(l_partkey AS VARCHAR), '.html') AS url_path,
  {_AVAIL} AS availability,
  CAST(p_size % 2 AS INTEGER) AS is_imported, CAST(s_nationkey % 2 AS INTEGER) AS is_authentic,
  CAST(l_linenumber % 2 AS INTEGER) AS tiki_verified,
  CASE WHEN {_NO_META} THEN NULL ELSE l_linenumber <= 2 END AS is_tikinow,
  CASE WHEN {_NO_META} THEN NULL ELSE l_quantity > 25 END AS is_tikipro,
  CASE WHEN {_NO_META} THEN NULL ELSE l_discount > 0.05 END AS is_ad,
  {_AVAIL} AS inventory_status,
  l_returnflag <> 'R' AS is_visible,
  CASE WHEN l_orderkey % 8 = 0 THEN {_q(UNKNOWN_ORIGIN)} ELSE concat('origin-', CAST(s_nationkey AS VARCHAR)) END AS origin,
  CAST(CASE WHEN l_orderkey % 13 = 0 THEN 0 ELSE l_linenumber % 3 END AS INTEGER) AS freegift_items,
  l_quantity > 10 AS shippable, l_suppkey AS seller_id,
  {_SELLER_TYPE} AS seller_type,
  CASE WHEN ({_SELLER_TYPE}) = 'OFFICIAL_STORE' THEN 1 ELSE 0 END AS is_official_store,
  CASE WHEN ({_SELLER_TYPE}) = 'TRUSTED_STORE' THEN 1 ELSE 0 END AS is_trusted_store,
  {_PATH} AS primary_category_path,
  CASE WHEN {_NO_META} THEN NULL ELSE concat(p_type, '-', CAST(p_size % 5 AS VARCHAR)) END AS category,
  p_type AS primary_category_name,
  CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_brand END AS brand_name,
  CAST(CASE WHEN l_orderkey % 97 = 0 THEN (length(p_brand) + 1) % 2 ELSE length(p_brand) % 2 END AS INTEGER) AS is_top_brand,
  CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 0 END AS is_flash_deal,
  CASE WHEN l_suppkey % 5 = 0 THEN 1 ELSE 0 END AS is_freeship_xtra,
  CASE WHEN l_orderkey % 13 <> 0 THEN 1 ELSE 0 END AS is_gift_available,
  l_tax > 0.05 AS bundle_deal,
  CAST(floor(l_extendedprice) AS BIGINT) AS price,
  CASE WHEN l_orderkey % 9 = 4 THEN NULL ELSE CAST(floor(l_extendedprice) AS BIGINT) - {_DISC} END AS list_price,
  CASE WHEN l_orderkey % 9 = 4 THEN NULL ELSE {_DISC} END AS discount,
  l_discount AS discount_rate, l_discount * 50 AS product_rating,
  CASE WHEN l_orderkey % 8 = 1 THEN NULL ELSE l_tax * 100 END AS rating_average,
  CAST(floor(l_quantity) AS BIGINT) AS review_count, CAST(l_linenumber AS BIGINT) AS favourite_count,
  CAST(floor(p_retailprice) AS BIGINT) AS original_price,
  CAST(floor(l_quantity * 10) AS BIGINT) AS all_time_quantity_sold,
  CAST(l_orderkey % 1000 AS BIGINT) AS number_of_reviews, CAST(l_orderkey % 100 AS BIGINT) AS search_rank,
  concat('data_', lower(l_returnflag), lower(l_linestatus)) AS _src_file,
  l_orderkey AS _o, l_partkey AS _p, l_suppkey AS _s
 FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
silver AS (
 SELECT * FROM lf
 QUALIFY row_number() OVER (PARTITION BY _src_file, id, sku, name, url_key, url_path ORDER BY _o, _p, _s) = 1)"""

_LOAD1 = ", ".join(_q(f) for f in LOAD1_FILES)
_ORD = "_src_file, _o, _p, _s"
_CAT = ["category", "primary_category_path", "primary_category_name"]
_CAT_ORDER = ", ".join(f"{c} NULLS FIRST" for c in _CAT)
_CAT_NS = " AND ".join(f"e.{c} IS NOT DISTINCT FROM n.{c}" for c in _CAT)
_PRODUCT_COLS = ("name, url_key, url_path, availability, is_imported, is_authentic, tiki_verified, "
                 "is_tikinow, is_tikipro, is_ad, inventory_status, is_visible, origin, freegift_items, shippable")

_CAT_JOIN_FULL = ("s.category = c.category AND s.primary_category_path = c.primary_category_path "
                  "AND s.primary_category_name = c.primary_category_name")


def _fact_cte(name: str, cat_join: str) -> str:
    return """{name} AS (
 SELECT s.id AS product_id, s.seller_id, c.category_id, b.brand_id,
  coalesce(price, 0) AS price, coalesce(list_price, 0) AS list_price, coalesce(discount, 0) AS discount,
  coalesce(discount_rate, 0) AS discount_rate, coalesce(rating_average, 0) AS rating_average,
  coalesce(review_count, 0) AS review_count, coalesce(favourite_count, 0) AS favourite_count,
  coalesce(original_price, 0) AS original_price,
  coalesce(all_time_quantity_sold, 0) AS all_time_quantity_sold,
  coalesce(number_of_reviews, 0) AS number_of_reviews, coalesce(search_rank, 0) AS search_rank
 FROM silver s
 JOIN dim_product p ON s.id = p.product_id
 JOIN dim_seller se ON s.seller_id = se.seller_id
 JOIN dim_category c ON {cat_join}
 JOIN dim_brand b ON s.brand_name = b.brand_name)""".format(name=name, cat_join=cat_join)


DIM_CTES = SILVER_CTES + f""",
load1 AS (SELECT * FROM silver WHERE _src_file IN ({_LOAD1})),
load2 AS (SELECT * FROM silver WHERE _src_file NOT IN ({_LOAD1})),
s1 AS (SELECT seller_id, seller_type, is_official_store, is_trusted_store FROM load1
       QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY {_ORD}) = 1),
s2 AS (SELECT seller_id, seller_type, is_official_store, is_trusted_store FROM load2
       QUALIFY row_number() OVER (PARTITION BY seller_id ORDER BY {_ORD}) = 1),
dim_seller AS (SELECT * FROM s1 UNION ALL
       SELECT * FROM s2 n WHERE NOT EXISTS (SELECT 1 FROM s1 e WHERE e.seller_id IS NOT DISTINCT FROM n.seller_id)),
c1 AS (SELECT DISTINCT category, primary_category_path, primary_category_name FROM load1),
c1k AS (SELECT row_number() OVER (ORDER BY {_CAT_ORDER}) AS category_id, * FROM c1),
c2 AS (SELECT DISTINCT category, primary_category_path, primary_category_name FROM load2 n
       WHERE NOT EXISTS (SELECT 1 FROM c1 e WHERE {_CAT_NS})),
c2k AS (SELECT (SELECT coalesce(max(category_id), 0) FROM c1k) + row_number() OVER (ORDER BY {_CAT_ORDER})
        AS category_id, * FROM c2),
dim_category AS (SELECT category_id, category, primary_category_path, primary_category_name,
       {levels('primary_category_path')} FROM (SELECT * FROM c1k UNION ALL SELECT * FROM c2k)),
b1 AS (SELECT brand_name, is_top_brand FROM load1
       QUALIFY row_number() OVER (PARTITION BY brand_name ORDER BY {_ORD}) = 1),
b1k AS (SELECT row_number() OVER (ORDER BY brand_name NULLS FIRST) AS brand_id, * FROM b1),
b2 AS (SELECT brand_name, is_top_brand FROM load2 n
       WHERE NOT EXISTS (SELECT 1 FROM b1 e WHERE e.brand_name IS NOT DISTINCT FROM n.brand_name)
       QUALIFY row_number() OVER (PARTITION BY brand_name ORDER BY {_ORD}) = 1),
b2k AS (SELECT (SELECT coalesce(max(brand_id), 0) FROM b1k) + row_number() OVER (ORDER BY brand_name NULLS FIRST)
        AS brand_id, * FROM b2),
dim_brand AS (SELECT * FROM b1k UNION ALL SELECT * FROM b2k),
p1 AS (SELECT id AS product_id, {lenient_long('sku')} AS sku, {_PRODUCT_COLS} FROM load1
       QUALIFY row_number() OVER (PARTITION BY id ORDER BY {_ORD}) = 1),
p2 AS (SELECT id AS product_id, {lenient_long('sku')} AS sku, {_PRODUCT_COLS} FROM load2 n
       WHERE NOT EXISTS (SELECT 1 FROM p1 e WHERE e.product_id IS NOT DISTINCT FROM n.id)
       QUALIFY row_number() OVER (PARTITION BY id ORDER BY {_ORD}) = 1),
dim_product AS (SELECT * FROM p1 UNION ALL SELECT * FROM p2),
{_fact_cte("fact", _CAT_JOIN_FULL)}"""

REVIEW_CTE = f"""
rv AS (
 SELECT doc_id AS id, CASE WHEN doc_id % 31 = 5 THEN NULL ELSE doc_id % 97 END AS product_id,
  CASE WHEN doc_id % 29 = 3 THEN NULL ELSE CAST(doc_id % 13 AS DOUBLE) END AS seller_id,
  source AS seller_name, doc_id * 7 AS customer_id,
  CASE WHEN doc_id % 10 = 0 THEN NULL ELSE {decorate_sql('text', 'doc_id')} END AS content,
  CAST(doc_id % 5 + 1 AS INTEGER) AS rating, 0 AS _c, doc_id AS _d
 FROM documents
 UNION ALL
 SELECT doc_id, CASE WHEN doc_id % 31 = 5 THEN NULL ELSE doc_id % 97 END,
  CASE WHEN doc_id % 29 = 3 THEN NULL ELSE CAST(doc_id % 13 AS DOUBLE) END,
  source, doc_id * 7, concat('DUP ', text), CAST(doc_id % 5 + 1 AS INTEGER), 1, doc_id
 FROM documents WHERE doc_id % 4 = 0)"""

_PAGE = f"CAST(floor(event_id / {PAGE_SPAN}) AS INTEGER)"
_BUCKET = f"CAST(user_id % {CATEGORY_USERS} AS INTEGER)"


def _fact_profile() -> str:
    parts = [("dim_seller", 4), ("dim_category", 8), ("dim_brand", 3), ("dim_product", 17), ("fact", 15)]
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_numbers, {n} AS column_numbers FROM {t}"
                              for t, n in parts)


# One load of all files into an empty mart.
RUN_CTES = DIM_CTES.replace(f"load1 AS (SELECT * FROM silver WHERE _src_file IN ({_LOAD1}))", "load1 AS (SELECT * FROM silver)").replace(
    f"load2 AS (SELECT * FROM silver WHERE _src_file NOT IN ({_LOAD1}))", "load2 AS (SELECT * FROM silver WHERE false)")
REVIEW_ROWS = f"""{REVIEW_CTE},
        rfirst AS (SELECT * FROM rv QUALIFY row_number() OVER (PARTITION BY id, product_id, seller_id ORDER BY _c, _d) = 1),
        review AS (SELECT id, product_id, CAST(seller_id AS BIGINT) AS seller_id, {clean_sql('content')} AS content, rating
        FROM rfirst WHERE id IS NOT NULL AND product_id IS NOT NULL AND seller_id IS NOT NULL)"""


SQL: dict[str, str] = {
    "nested_flatten": """SELECT p_partkey AS id, p_brand AS brand_name, p_type AS primary_category_name,
        CAST(p_size AS BIGINT) AS search_rank,
        CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE concat('origin-', CAST(p_size AS VARCHAR)) END AS origin
        FROM part""",
    "array_first_field": """SELECT p_partkey AS id,
        CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS category,
        CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size > 25 END AS is_ad FROM part""",
    "array_length": """SELECT doc_id, CAST(CASE WHEN doc_id % 5 = 0 THEN 0
        ELSE len(string_split(text, ' ')) END AS INTEGER) AS n_words FROM documents""",
    "dedup_keep_first": """SELECT event_id, ts, user_id, event_type, value, props FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
    "dedup_any": "SELECT DISTINCT user_id, event_type FROM events",
    "distinct_rows": "SELECT DISTINCT p_brand, p_type FROM part",
    "union_partitions": f"""SELECT event_id, ts, user_id, event_type, value,
        CASE WHEN coalesce(((event_id % {BRANCHES}) + {BRANCHES}) % {BRANCHES}, 0) = 1 THEN NULL ELSE props END AS props FROM events""",
    "null_fill_constants": f"""SELECT p_partkey,
        CASE WHEN p_partkey % 5 = 0 THEN {_q(UNKNOWN_ORIGIN)} ELSE p_brand END AS p_brand,
        CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE p_size END AS p_size,
        CASE WHEN p_partkey % 11 = 0 THEN 'None' ELSE p_type END AS p_type FROM part""",
    "null_fill_numeric": """SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS p_brand,
        CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE p_size END AS p_size,
        CASE WHEN p_partkey % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE p_retailprice END AS p_retailprice FROM part""",
    "drop_null_keys": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
        WHERE l_orderkey % 17 <> 0 AND l_partkey % 19 <> 0 AND l_suppkey % 23 <> 0""",
    "enum_flags": """SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
        CASE WHEN c_custkey % 9 <> 0 AND c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS is_official_store,
        CASE WHEN c_custkey % 9 <> 0 AND c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS is_trusted_store
        FROM customer""",
    "price_override": f"""SELECT l_orderkey AS order_id, l_partkey, l_suppkey,
        CAST(floor(l_extendedprice) AS BIGINT) AS price,
        CASE WHEN l_orderkey % 9 = 4 THEN NULL ELSE {_DISC} END AS discount,
        {_AVAIL} AS availability,
        CASE WHEN l_orderkey % 9 = 4 THEN NULL ELSE CAST(floor(l_extendedprice) AS BIGINT) - {_DISC} END AS list_price,
        {_AVAIL} AS inventory_status FROM lineitem""",
    "cast_keys": """SELECT o_orderkey,
        CASE WHEN o_orderkey % 13 = 0 THEN concat(CAST(o_orderkey AS VARCHAR), 'x')
             WHEN o_orderkey % 17 = 0 THEN concat(CAST(o_orderkey AS VARCHAR), '.0')
             ELSE CAST(o_orderkey AS VARCHAR) END AS key_text,
        CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey END AS key_long FROM orders""",
    "path_levels": f"SELECT page_id, url AS primary_category_path, {levels('url')} FROM pages",
    "clean_text_documents": f"SELECT doc_id, {clean_sql(decorate_sql('text', 'doc_id'))} AS content FROM documents",
    "clean_text_pages": f"SELECT page_id, {clean_sql('html')} AS content FROM pages",
    "clean_text_conversations": f"""SELECT conv_id, turn,
        {clean_sql(decorate_sql('text', 'conv_id + turn'))} AS content FROM conversations""",
    "new_keys_single": """WITH inc AS (SELECT CASE WHEN s_suppkey % 10 = 1 THEN NULL ELSE s_suppkey END AS s_suppkey,
        s_name, s_nationkey, s_nationkey < 10 AS known FROM supplier)
        SELECT s_suppkey, s_name, s_nationkey FROM inc n
        WHERE NOT EXISTS (SELECT 1 FROM inc e WHERE e.known AND e.s_suppkey IS NOT DISTINCT FROM n.s_suppkey)""",
    "new_keys_composite": """WITH inc AS (SELECT DISTINCT CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END
        AS p_brand, p_type, p_size FROM part)
        SELECT * FROM inc n WHERE NOT EXISTS (SELECT 1 FROM inc e WHERE e.p_size <= 20
          AND e.p_brand IS NOT DISTINCT FROM n.p_brand AND e.p_type IS NOT DISTINCT FROM n.p_type
          AND e.p_size IS NOT DISTINCT FROM n.p_size)""",
    "new_keys_null_unsafe": """WITH inc AS (SELECT DISTINCT CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END
        AS p_brand, p_type, p_size FROM part)
        SELECT * FROM inc n WHERE NOT EXISTS (SELECT 1 FROM inc e WHERE e.p_size <= 20
          AND e.p_brand = n.p_brand AND e.p_type = n.p_type AND e.p_size = n.p_size)""",
    "product_rejoin": f"""WITH inc AS (SELECT l_partkey AS product_id,
          CASE WHEN l_linenumber = 7 THEN concat(CAST(l_partkey AS VARCHAR), '.0')
               WHEN l_linenumber = 6 THEN concat('SKU', CAST(l_partkey AS VARCHAR))
               ELSE CAST(l_partkey AS VARCHAR) END AS sku,
          p_name AS name, CAST(floor(l_extendedprice) AS BIGINT) AS price, l_orderkey, l_suppkey
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type IN ('ECONOMY', 'PROMO')))
        SELECT product_id, {lenient_long('sku')} AS sku, name, price FROM inc
        QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY l_orderkey, product_id, l_suppkey) = 1""",
    "surrogate_keys": """WITH ex AS (SELECT DISTINCT CAST(substr(p_brand, 7) AS BIGINT) * 10 AS brand_id,
          p_brand AS brand_name FROM part WHERE length(p_brand) = 7),
        nw AS (SELECT DISTINCT p_brand AS brand_name FROM part WHERE p_brand NOT IN (SELECT brand_name FROM ex))
        SELECT brand_id, brand_name FROM ex UNION ALL
        SELECT (SELECT coalesce(max(brand_id), 0) FROM ex) + row_number() OVER (ORDER BY brand_name NULLS FIRST),
          brand_name FROM nw""",
    "dim_seller": f"WITH {DIM_CTES} SELECT * FROM dim_seller",
    "dim_category": f"WITH {DIM_CTES} SELECT * FROM dim_category",
    "dim_brand": f"WITH {DIM_CTES} SELECT * FROM dim_brand",
    "dim_product": f"WITH {DIM_CTES} SELECT * FROM dim_product",
    "fact_star_join": f"WITH {DIM_CTES} SELECT * FROM fact",
    "dim_seller_full_row": f"""WITH {SILVER_CTES}
        SELECT DISTINCT seller_id, seller_type, is_official_store, is_trusted_store FROM silver""",
    "silver_products": f"WITH {SILVER_CTES} SELECT {SILVER_COLS} FROM silver",
    "silver_reviews": f"""WITH {REVIEW_CTE},
        firsts AS (SELECT * FROM rv QUALIFY row_number() OVER (PARTITION BY id, product_id, seller_id ORDER BY _c, _d) = 1)
        SELECT id, product_id, CAST(seller_id AS BIGINT) AS seller_id, {clean_sql('content')} AS content, rating
        FROM firsts WHERE id IS NOT NULL AND product_id IS NOT NULL AND seller_id IS NOT NULL""",
    "table_profile": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_numbers, {DRIVER_COLUMNS[t]} AS column_numbers FROM {t}"
        for t in DRIVER_TABLES),
    "page_landing": f"""WITH p AS (SELECT concat_ws('-', event_type, CAST({_BUCKET} AS VARCHAR)) AS category, {_BUCKET} AS bucket,
          {_PAGE} AS page, event_id, user_id, value FROM events),
        n AS (SELECT CAST(floor(max(event_id) / {PAGE_SPAN}) AS INTEGER) + 1 AS pages FROM events),
        stops AS (SELECT DISTINCT category, page AS stop FROM p, n
                  WHERE bucket < {CATEGORY_USERS - 1} AND page = CAST(floor(pages * (bucket + 1) / {CATEGORY_USERS + 1}) AS INTEGER))
        SELECT p.category, p.page, event_id, user_id, value FROM p LEFT JOIN stops s ON p.category = s.category
        WHERE s.stop IS NULL OR p.page < s.stop""",
    "parquet_roundtrip": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
    "csv_roundtrip": f"WITH {REVIEW_CTE} SELECT id, product_id, seller_id, seller_name, customer_id, content, rating, concat('n', CAST(id AS VARCHAR)) AS note FROM rv",
    "mart_roundtrip": "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier",
    "medallion_two_loads": f"WITH {DIM_CTES} {_fact_profile()}",
    "medallion_run": f"""WITH {RUN_CTES}, {REVIEW_ROWS}
        SELECT 'bronze_product' AS table_name, count(*) AS row_numbers, 25 AS column_numbers FROM lf UNION ALL
        SELECT 'bronze_review', count(*), 9 FROM rv UNION ALL
        SELECT 'silver_product', count(*), 44 FROM silver UNION ALL
        SELECT 'silver_review', count(*), 5 FROM review UNION ALL
        SELECT 'review', count(*), 5 FROM review UNION ALL {_fact_profile()}""",
    "medallion_fact": f"WITH {RUN_CTES} SELECT * FROM fact",
    "medallion_reviews": f"WITH {REVIEW_ROWS} SELECT * FROM review",
    # the third load finds the dimensions that the first two have made
    "medallion_loads": f"""WITH {DIM_CTES}, of_load AS (SELECT 'stream' AS load UNION ALL SELECT 'run-all')
        SELECT fact.*, load FROM fact CROSS JOIN of_load""",
    "medallion_reload": f"""WITH {RUN_CTES}, less AS (SELECT * FROM silver WHERE _src_file IN ({_LOAD1})),
        {_fact_cte("again", _CAT_JOIN_FULL).replace("FROM silver s", "FROM less s")} SELECT * FROM again""",
    "medallion_reload_dims": f"""WITH {RUN_CTES} SELECT 'dim_seller' AS table_name, seller_id AS key, seller_type AS text FROM dim_seller
        UNION ALL SELECT 'dim_category', category_id, category FROM dim_category UNION ALL SELECT 'dim_brand', brand_id, brand_name FROM dim_brand
        UNION ALL SELECT 'dim_product', product_id, name FROM dim_product""",
    "medallion_profiles": f"""WITH {DIM_CTES}, {REVIEW_ROWS},
        {_fact_cte("fact2", _CAT_JOIN_FULL).replace("FROM silver s", "FROM load2 s")},
        counts AS (SELECT 'bronze_product' AS table_name, count(*) AS row_numbers, 25 AS column_numbers, count(*) AS current_rows FROM lf WHERE _src_file NOT IN ({_LOAD1})
        UNION ALL SELECT 'silver_product', count(*), 44, count(*) FROM load2
        UNION ALL SELECT 'bronze_review', count(*), 9, count(*) FROM rv
        UNION ALL SELECT 'silver_review', count(*), 5, count(*) FROM review
        UNION ALL SELECT 'review', count(*), 5, 2 * count(*) FROM review
        UNION ALL SELECT 'dim_seller', (SELECT count(*) FROM dim_seller) - count(*), 4, (SELECT count(*) FROM dim_seller) FROM s1
        UNION ALL SELECT 'dim_category', (SELECT count(*) FROM dim_category) - count(*), 8, (SELECT count(*) FROM dim_category) FROM c1k
        UNION ALL SELECT 'dim_brand', (SELECT count(*) FROM dim_brand) - count(*), 3, (SELECT count(*) FROM dim_brand) FROM b1k
        UNION ALL SELECT 'dim_product', (SELECT count(*) FROM dim_product) - count(*), 17, (SELECT count(*) FROM dim_product) FROM p1
        UNION ALL SELECT 'fact', count(*), 15, (SELECT count(*) FROM fact) FROM fact2)
        SELECT * FROM counts""",
}
