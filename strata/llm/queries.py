"""The registered queries of this package, one for each operator, and their DuckDB SQL."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, crf_langid, importance, merkle, nn_descent, piece_bpe, ppm, prefix_trie, probminhash, ss_packing, superkmer, toxicity, tree_dedup
from strata.llm.common import documents, remainder


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), remainder("doc_id", 5) == 0)


def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.93)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_langid.predict_language(documents(spark, sf_dir), remainder("doc_id", 4) == 2)


def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(documents(spark, sf_dir), remainder("doc_id", 7) == 2)


def op6_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: texts labelled good (quality 1) outside the held-out fifth; as large a share of all rows is kept as is good among the labelled."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    learned = labels.filter(remainder("doc_id", 5) != 0)
    fraction = learned.agg(F.coalesce(F.avg("quality"), F.lit(1.0))).first()[0]
    # the ids are bounded and sent to the texts, which stay where they are
    good = importance.chosen_ids(learned.filter("quality = 1").select("doc_id")).withColumn("good", F.lit(True))
    docs = documents(spark, sf_dir).join(F.broadcast(good), "doc_id", "left")
    out = importance.resample(docs, F.col("good"), fraction, "doc_id", "text", (remainder("doc_id", 5) == 0).alias("held_out"))
    return out.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), F.col("log_weight")))))).withColumn("kept", F.col("selected"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_dedup.exact_duplicates(documents(spark, sf_dir), largest=True).drop("text_key")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ss_packing.pack_documents(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), end_id=1, capacity=4096)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(documents(spark, sf_dir), words=5, threshold=0.8).drop("text_key")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmer.remove_repeats(documents(spark, sf_dir), width=13).drop("kept")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations begin with the first turns of the one whose id is the next multiple of 5 below."""
    turns = prefix_trie.turn_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return prefix_trie.trie(*prefix_trie.share_heads(turns, F.col("conv") - F.col("conv") % 5, remainder("conv", 9)))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document (by crc32 of the id) is found with its text in lower case."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    found = [*fields[:-1], F.when(remainder("doc_id", 3) == 0, lowered).otherwise(F.col("text"))]
    return merkle.prove(documents(spark, sf_dir), fields, found, tree="lang", id_col="doc_id").drop("path")


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.round_trip(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_nn_descent, op3_bpe, op4_language, op5_ppm, op6_importance, op7_exact_dedup, op8_packing, op9_near_dedup, op10_substring_dedup,
                                   op11_prefix_trie, op12_merkle, op13_sentencepiece)}

#: CTEs: the table of CRC-32 by its polynomial; ``crc_of`` is the checksum of a text of ASCII characters with it.
CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
               lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t)"""


def crc_of(text: str) -> str:
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)),
               lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)))"""


SQL = {
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op10_substring_dedup": r"""
        WITH d AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w
                   FROM documents),
        s AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d),
        win AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 12], ' ')) AS g FROM s),
        least AS (SELECT g, min(doc_id) AS first_id FROM win GROUP BY g),
        hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM win JOIN least USING (g) WHERE first_id < doc_id),
        gone AS (SELECT doc_id, list(j) AS js FROM hit GROUP BY doc_id),
        kept AS (SELECT doc_id, w, coalesce(js, []) AS js, [w[k] FOR k IN range(1, len(w) + 1) IF NOT list_contains(coalesce(js, []), k)] AS left_words
                 FROM d LEFT JOIN gone USING (doc_id))
        SELECT doc_id, len(w)::BIGINT AS n_words, len(js)::BIGINT AS n_removed, sha256(array_to_string(left_words, ' ')) AS kept_sha256 FROM kept""",
    "op11_prefix_trie": f"""
        WITH {CRC_TABLE},
        turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos
                  FROM conversations WHERE conv_id IS NOT NULL),
        sizes AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS head FROM turns GROUP BY conv_id),
        asked AS (SELECT *, {crc_of("conv_id::VARCHAR")} % 9 AS h FROM sizes, crc),
        convs AS (SELECT a.conv_id, a.head, a.h, least(a.h, coalesce(s.n, 0)) AS taken FROM asked a LEFT JOIN sizes s ON s.conv_id = a.head),
        rebuilt AS (SELECT c.conv_id, pos AS depth, role, text FROM convs c JOIN turns t ON t.conv_id = c.head AND pos <= taken
                    UNION ALL SELECT conv_id, taken + pos - h, role, text FROM convs JOIN turns USING (conv_id) WHERE pos > h),
        prefixes AS (SELECT conv_id, depth, strlen(text) AS bytes, sha256(string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS k
                     FROM rebuilt UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
        nodes AS (SELECT depth, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM prefixes GROUP BY depth, k),
        lengths AS (SELECT conv_id, max(depth) AS depth FROM prefixes GROUP BY conv_id),
        ends AS (SELECT depth, k, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS e FROM prefixes JOIN lengths USING (conv_id, depth) GROUP BY depth, k),
        links AS (SELECT DISTINCT c.depth, c.k, u.k AS uk FROM prefixes c JOIN prefixes u ON c.conv_id = u.conv_id AND c.depth = u.depth + 1),
        children AS (SELECT depth - 1 AS depth, uk AS k, count(*) AS n FROM links GROUP BY ALL),
        below AS (SELECT DISTINCT u.depth, u.k, c.depth AS cd, c.k AS ck FROM prefixes u JOIN prefixes c ON c.conv_id = u.conv_id AND c.depth >= u.depth),
        sums AS (SELECT b.depth, b.k, count(*) FILTER (h.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes)::BIGINT AS saved
                 FROM below b JOIN nodes n ON n.depth = cd AND n.k = ck LEFT JOIN children h ON h.depth = cd AND h.k = ck GROUP BY b.depth, b.k)
        SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, n_leaves, saved AS saved_tokens, coalesce(e, sha256('')) AS ends_sha256
        FROM nodes n JOIN sums USING (depth, k) LEFT JOIN children c USING (depth, k) LEFT JOIN ends USING (depth, k)
        LEFT JOIN links l ON l.depth = n.depth AND l.k = n.k LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.k = l.uk""",
    "op12_merkle": f"""
        WITH RECURSIVE {CRC_TABLE},
        named AS (SELECT *, CASE WHEN {crc_of("coalesce(doc_id::VARCHAR, '')")} % 3 = 0
                                 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS seen FROM documents, crc),
        fields AS (SELECT doc_id, lang, [doc_id::VARCHAR, source, lang, n_chars::VARCHAR, text] AS a, [doc_id::VARCHAR, source, lang, n_chars::VARCHAR, seen] AS b FROM named),
        digests AS (SELECT doc_id, lang, sha256(array_to_string(list_transform(a, lambda x: coalesce(strlen(x) || ':' || x, '-')), '')) AS leaf,
                           sha256(array_to_string(list_transform(b, lambda x: coalesce(strlen(x) || ':' || x, '-')), '')) AS found FROM fields),
        leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM digests),
        up AS (SELECT 0 AS h, lang, rank, leaf AS d, count(*) OVER (PARTITION BY lang) AS n FROM leaves
               UNION ALL SELECT h + 1, lang, rank // 8, sha256(string_agg(d, '' ORDER BY rank)), (n + 7) // 8 FROM up WHERE n > 1 GROUP BY h, lang, rank // 8, n),
        subroots AS (SELECT h, lang, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM up WHERE n = 1),
        top AS (SELECT 0 AS h, place AS rank, subroot AS d, count(*) OVER () AS n FROM subroots
                UNION ALL SELECT h + 1, rank // 8, sha256(string_agg(d, '' ORDER BY rank)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY h, rank // 8, n),
        beside AS (SELECT a.h, a.lang, a.rank, coalesce(string_agg(b.d, '' ORDER BY b.rank) FILTER (b.rank < a.rank), '') AS l,
                          coalesce(string_agg(b.d, '' ORDER BY b.rank) FILTER (b.rank > a.rank), '') AS r
                   FROM up a JOIN up b ON a.h = b.h AND a.lang IS NOT DISTINCT FROM b.lang AND a.rank // 8 = b.rank // 8 WHERE a.n > 1 GROUP BY ALL),
        beside_top AS (SELECT a.h, a.rank, coalesce(string_agg(b.d, '' ORDER BY b.rank) FILTER (b.rank < a.rank), '') AS l,
                              coalesce(string_agg(b.d, '' ORDER BY b.rank) FILTER (b.rank > a.rank), '') AS r
                       FROM top a JOIN top b ON a.h = b.h AND a.rank // 8 = b.rank // 8 WHERE a.n > 1 GROUP BY ALL),
        fold AS (SELECT 0 AS h, doc_id, lang, leaf, rank, found AS acc, '' AS beside FROM leaves
                 UNION ALL SELECT f.h + 1, doc_id, f.lang, leaf, f.rank // 8, sha256(l || acc || r), f.beside || l || r
                 FROM fold f JOIN beside b ON f.h = b.h AND f.lang IS NOT DISTINCT FROM b.lang AND f.rank = b.rank),
        folded AS (SELECT f.*, subroot, place FROM fold f JOIN subroots s ON f.h = s.h AND f.lang IS NOT DISTINCT FROM s.lang),
        fold_top AS (SELECT 0 AS h, doc_id, leaf, subroot, place AS rank, acc, beside FROM folded
                     UNION ALL SELECT f.h + 1, doc_id, leaf, subroot, f.rank // 8, sha256(l || acc || r), f.beside || l || r
                     FROM fold_top f JOIN beside_top b ON f.h = b.h AND f.rank = b.rank)
        SELECT doc_id, leaf, subroot, d AS root, sha256(beside) AS proof_sha256, acc AS folded_root, acc = d AS verified
        FROM fold_top f JOIN top t ON f.h = t.h WHERE t.n = 1""",
}
