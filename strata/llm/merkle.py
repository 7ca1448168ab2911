"""A Merkle manifest of a dataset, kept as a content-addressed DAG of digest-to-children records.

Every row is a leaf. The leaves of one tree, by id, are folded in runs of ``FAN_OUT`` until one
node is left, and the trees' roots are folded likewise into the root of the dataset. Each node is a record
(digest, children) in a store written once, one folder for each height.

Requests for leaves descend from the root by the digits of their rank: the record of a digest names the
children, the digit selects one, and the unselected children to its left and right are a segment of the path. Requests
with a common path travel as one row, so a record is met once however many leaves lie below it, and
the requests of a last run of leaves join it as one row. The segments, reversed, lead from leaf to root.

Defined results: a null field is written ``-``; rows with one id tie, and are ordered by leaf digest (equal
rows are equal leaves); a null id sorts first; a null tree name is a tree of its own and sorts
first; a tree of one leaf has the leaf as its root; an empty table has no rows and no root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import numbered
from strata.session import materialize, scratch_path

FAN_OUT = 8
SEGMENTS = "array<struct<left:string,right:string>>"


def digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each with its length in bytes before it."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text)), 256)


@dataclass
class Forest:
    """The records of trees: a folder ``height=<h>`` in ``path`` for each height, and the roots (tree, digest, height)."""
    path: str
    height: int
    roots: DataFrame

    def records(self, height: int) -> DataFrame:
        return self.roots.sparkSession.read.parquet(f"{self.path}/height={height}")


def build(leaves: DataFrame) -> Forest:
    """Fold leaves (tree, rank, size, digest) upwards, one grouping a height; a run is ``FAN_OUT`` rows at most."""
    spark = leaves.sparkSession
    path = scratch_path(spark, "records")
    left, height = leaves.agg(F.max("size")).first()[0] or 0, 0
    level = leaves.select("tree", "rank", "size", "digest")
    roots = level.filter("size = 1").select("tree", "digest", F.lit(0).alias("height"))
    while left > 1:
        left, height = -(-left // FAN_OUT), height + 1
        run = F.floor(F.col("rank") / FAN_OUT)
        grouped = (level.filter("size > 1").groupBy("tree", run.alias("rank"))
                   .agg(F.ceil(F.first("size") / FAN_OUT).alias("size"), F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("run")))
        children = F.transform("run", lambda x: x["digest"])
        level = materialize(grouped.select("tree", "rank", "size", children.alias("children"))
                            .withColumn("digest", F.sha2(F.array_join("children", ""), 256)), "level")
        # equal nodes are one record
        level.select("digest", "children").dropDuplicates(["digest"]).write.parquet(f"{path}/height={height}")
        level = level.drop("children")
        roots = roots.union(level.filter("size = 1").select("tree", "digest", F.lit(height).alias("height")))
    return Forest(path, height, materialize(roots, "roots"))


def descend(forest: Forest, starts: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """From the roots ``starts`` (tree, digest, height, path, further columns) down to the last runs of leaves.

    One row for each run: tree, run (its leaves' ranks divided by ``FAN_OUT``), children, path (segments from the root), and the further
    columns; a tree of one leaf is a run with that child alone and no segment of its own. With ``wanted`` (tree, rank) only
    runs with leaves asked for are reached.
    """
    more = [c for c in starts.columns if c not in ("tree", "digest", "height", "path")]
    keep = ["tree", "rank", "digest", "path", *more]
    starts = starts.withColumn("rank", F.lit(0).cast("long"))
    front = starts.filter(F.lit(False)).select(keep)
    done = starts.filter("height = 0").select("tree", F.col("rank").alias("run"), F.array("digest").alias("children"), "path", *more)
    for height in range(forest.height, 0, -1):
        here = front.union(starts.filter(F.col("height") == height).select(keep))
        if wanted is not None:
            asked = wanted.select(F.col("tree").alias("_t"), F.floor(F.col("rank") / FAN_OUT ** height).alias("_r")).distinct()
            here = here.join(asked, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("rank") == F.col("_r")), "left_semi")
        met = here.join(forest.records(height), "digest")
        if height == 1:
            return done.union(met.select("tree", F.col("rank").alias("run"), "children", "path", *more))
        digits = met.select("tree", "rank", "path", "children", *more, F.posexplode("children").alias("digit", "digest"))
        front = digits.select("tree", (F.col("rank") * FAN_OUT + F.col("digit")).alias("rank"), "digest",
                              F.concat("path", F.array(segment(F.col("children"), F.col("digit")))).alias("path"), *more)
    return done


def segment(children: Column, digit: Column) -> Column:
    """The unselected children, left and right of the selected one."""
    return F.struct(F.array_join(F.slice(children, F.lit(1), digit), "").alias("left"),
                    F.array_join(F.slice(children, digit + 2, F.lit(FAN_OUT)), "").alias("right"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the segments of its path."""
    return F.aggregate(F.reverse(path), leaf, lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]), 256))


def proof(path: Column) -> Column:
    """SHA-256 of the siblings, from leaf to root."""
    return F.sha2(F.array_join(F.transform(F.reverse(path), lambda s: F.concat(s["left"], s["right"])), ""), 256)


def prove(rows: DataFrame, fields: list[Column], recomputed: list[Column], tree: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """One row per row: id, leaf, subroot, root, path (segments from root to leaf), proof_sha256, folded_root and verified.

    ``fields`` make the leaves of the manifest; ``recomputed`` are the fields as they are found now, which
    the stored siblings lead to a root: ``verified`` tells whether that is the manifest's root.
    """
    src = rows.select(F.col(tree).cast("string").alias("tree"), F.col(id_col).alias("id"), digest(fields).alias("leaf"), digest(recomputed).alias("found"))
    src = src.withColumn("found", F.when(F.col("found") != F.col("leaf"), F.col("found")))
    leaves = numbered(src, ["tree"], ["id", "leaf"], "leaves")
    forest = build(leaves.withColumnRenamed("leaf", "digest"))

    # the trees' roots are the leaves of the upper tree
    names = materialize(numbered(forest.roots.withColumn("all", F.lit(0)), ["all"], ["tree"], "subroots"), "subroots")
    upper = build(names.select(F.col("all").alias("tree"), "rank", "size", "digest"))
    top = upper.roots.select("tree", "digest", "height", F.array().cast(SEGMENTS).alias("path"), F.col("digest").alias("root"))
    runs = descend(upper, top).select("run", "path", "root", "children", F.posexplode("children").alias("digit", "subroot"))
    above = runs.select((F.col("run") * FAN_OUT + F.col("digit")).alias("rank"), own_path("root").alias("path"), "root", "subroot")
    starts = names.select("tree", "digest", "height", "rank").join(above, "rank").drop("rank")

    asked = leaves.groupBy("tree", F.floor(F.col("rank") / FAN_OUT).alias("run")).agg(
        F.collect_list(F.struct((F.col("rank") % FAN_OUT).cast("int").alias("digit"), "id", "leaf", "found")).alias("requests"))
    asked = asked.select(F.col("tree").alias("_t"), F.col("run").alias("_r"), "requests")
    met = descend(forest, starts).join(asked, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("run") == F.col("_r")))
    each = met.select("subroot", "root", "path", "children", F.inline("requests"))
    each = each.withColumn("path", own_path("subroot"))
    out = each.select(F.col("id").alias(id_col), "leaf", "subroot", "root", "path", proof(F.col("path")).alias("proof_sha256"),
                      fold(F.coalesce("found", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def own_path(root: str) -> Column:
    """The path of the child ``digit`` of a run; a tree of one leaf, which is its ``root``, adds no segment."""
    alone = (F.size("children") == 1) & (F.element_at("children", 1) == F.col(root))
    return F.when(alone, F.col("path")).otherwise(F.concat("path", F.array(segment(F.col("children"), F.col("digit")))))
