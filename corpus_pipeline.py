"""A cleaning pipeline over ``documents``, built from the operators in strata.llm.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm import probminhash, ss_packing, superkmer, toxicity, tree_dedup
from strata.llm.common import remainder
from strata.llm.queries import vocabulary
from strata.session import materialize


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of ``docs`` for each (doc_id, text_key) of ``kept``; a null doc_id meets a null one."""
    names = ["_id", "_text"]
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(2 ** 63 - 1))
    mine = docs.withColumns({"_id": number, "_text": F.xxhash64(F.coalesce("text", F.lit("")))})
    found = mine.join(kept.select(number.alias("_id"), F.col("text_key").alias("_text")), names, "left_semi")
    first = F.row_number().over(Window.partitionBy(*names).orderBy(*names))
    return found.withColumn("_nth", first).filter("_nth = 1").select(docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts whose score is 0.5 or more. A null text counts as empty, without evidence; repeated rows
    have equal scores and stay or go together; without labels nothing is rejected."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(docs, labels, remainder("doc_id", 5) == 0, carry=docs.columns)
    return scored.filter("predicted = 0").select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays; of rows that tie, one. Null texts are equal to empty ones; a null
    doc_id stays only where its texts have no other."""
    return keep_rows(docs, tree_dedup.exact_duplicates(docs, largest=True).filter("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the row with the smallest doc_id stays (a null one is the largest); of rows that
    tie, one. A null or empty text, or one under five words, is near to equal texts only."""
    return keep_rows(docs, probminhash.near_duplicates(docs, words=5, threshold=0.8).filter("kept"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that a document with a smaller doc_id has too are removed; n_chars follows the text. Rows with one
    doc_id never cut each other; a null doc_id is the largest; null texts stay null, and texts without a cut stay as they are."""
    cut = superkmer.remove_repeats(docs, width=13, carry=docs.columns)
    changed = F.col("n_removed") > 0
    return cut.withColumn("text", F.col("kept")).withColumn(
        "n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of 4096 tokens. A null or empty text is one piece, its end id; rows with one doc_id are
    documents of their own."""
    return ss_packing.pack_documents(docs, vocabulary("word_bpe_49k.json"), end_id=1, capacity=4096)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("packing", pack_sequences),
]

#: Sequences are made of tokenizer ids, and models decide; SQL can't express that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
