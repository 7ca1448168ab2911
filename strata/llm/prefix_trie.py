"""A prefix trie over conversations, by balanced parentheses in shards.

Every turn has a random 120-bit code of its place and content; the XOR of a conversation's first
codes names its prefix, so equal prefixes meet by name in one grouping and a long conversation needs no single task. Nodes
where all conversations go on to the same child only lengthen an edge; the others (branches and
ends) are kept. The distinct conversations, as lists of kept nodes, are range-sorted, and each Arrow batch of
a sorted partition is a shard. In a shard (numpy):

* the common beginnings of neighbours give the trie as balanced parentheses;
* blocks with their least and largest excess, under a binary tree, find the closing parenthesis that delimits a subtree;
* the rank of leaf pairs "()" counts its leaves, and a cumulative array over the nodes in preorder its savings.

The spine that a shard shares with the ones beside it is in both; a node's own amounts are counted only where its smallest
conversation is, so the shards' rows for a node add up. Edges are lengthened to their nodes at the end.

Defined results: rows without conv_id belong to no conversation; null role or text counts as empty; turns
that tie are ordered by role, then by the SHA-256 of the text, and are turns of their own (rows repeated too);
an empty table has no node.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import numbered
from strata.session import materialize

NODE = ["depth", "ka", "kb"]
#: Parentheses in a block of least and largest excess; turns of a conversation whose codes one task sums up; ids in a piece of an ends list.
BLOCK, RUN, PIECE = 256, 4096, 4096


def turn_rows(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn: conv, rank (from 0), size (turns of the conversation), role, sha (digest of the text), bytes."""
    text_of = F.coalesce(F.col(text), F.lit(""))
    src = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.sha2(text_of, 256).alias("sha"), F.octet_length(text_of).cast("long").alias("bytes"))
    return materialize(numbered(src, ["conv"], ["turn", "role", "sha"], "turns").drop("turn"), "ranks")


def share_heads(turns: DataFrame, head: Column, heads: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with another's first turns: (conv, length) and rows (conv, depth from 1, role, sha, bytes).

    ``head`` names, from ``conv``, the conversation whose first ``heads`` turns come first (all it has if fewer, none if it is absent);
    ``conv``'s own turns after its first ``heads`` follow. ``heads`` is small and bounded.
    """
    sizes = turns.filter("rank = 0").select("conv", "size")
    asked = sizes.withColumns({"h": heads.cast("long"), "head": head})
    there = sizes.select(F.col("conv").alias("head"), F.col("size").alias("head_size"))
    convs = asked.join(there, "head", "left").withColumn("taken", F.least("h", F.coalesce("head_size", F.lit(0))))
    convs = materialize(convs.select("conv", "h", "head", "taken", (F.col("taken") + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("length")), "convs")
    own = turns.join(convs, "conv").filter("rank >= h").select("conv", (F.col("taken") + F.col("rank") - F.col("h") + 1).alias("depth"), "role", "sha", "bytes")
    places = convs.filter("taken > 0").select(F.col("conv").alias("to"), F.col("head").alias("conv"), F.explode(F.sequence(F.lit(0), F.col("taken") - 1)).alias("rank"))
    lent = places.join(turns, ["conv", "rank"]).select(F.col("to").alias("conv"), (F.col("rank") + 1).alias("depth"), "role", "sha", "bytes")
    return convs.select("conv", "length"), lent.union(own)


def prefix_rows(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conversation and depth, the root too: conv, depth, ka, kb (the prefix's name), ua, ub (its parent's), bytes, total (bytes so far), last."""
    code = F.sha2(F.concat_ws(":", "depth", F.octet_length("role"), "role", "sha"), 256)
    half = lambda at: F.conv(F.substring(code, at, 15), 16, 10).cast("long")
    coded = rows.select("conv", "depth", "bytes", half(1).alias("a"), half(16).alias("b"))
    zero = F.lit(0).cast("long")
    coded = coded.union(convs.select("conv", zero, zero, zero, zero)).withColumn("run", F.floor(F.col("depth") / RUN))
    here = Window.partitionBy("conv", "run").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    within = coded.withColumns({"ka": F.expr("bit_xor(a)").over(here), "kb": F.expr("bit_xor(b)").over(here), "total": F.sum("bytes").over(here)})
    # runs of a long conversation go on from the runs before them
    runs = coded.groupBy("conv", "run").agg(F.expr("bit_xor(a)").alias("xa"), F.expr("bit_xor(b)").alias("xb"), F.sum("bytes").alias("xt"))
    before = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    carry = runs.select("conv", "run", F.expr("bit_xor(xa)").over(before).alias("ca"), F.expr("bit_xor(xb)").over(before).alias("cb"),
                        F.sum("xt").over(before).alias("ct")).filter("run > 0")
    named = within.join(carry, ["conv", "run"], "left").join(convs, "conv").select(
        "conv", "depth", "bytes", "a", "b", F.col("ka").bitwiseXOR(F.coalesce("ca", zero)).alias("ka"), F.col("kb").bitwiseXOR(F.coalesce("cb", zero)).alias("kb"),
        (F.col("total") + F.coalesce("ct", zero)).alias("total"), (F.col("depth") == F.col("length")).alias("last"))
    return materialize(named.withColumns({"ua": F.col("ka").bitwiseXOR(F.col("a")), "ub": F.col("kb").bitwiseXOR(F.col("b"))}).drop("a", "b"), "prefixes")


def node_rows(prefixes: DataFrame) -> DataFrame:
    """One row per node: NODE, n_convs, conv (smallest member), ends and end_conv (members that end here, the smallest), n_children, bytes, total."""
    nodes = prefixes.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv"), F.count_if("last").alias("ends"), F.min(F.when(F.col("last"), F.col("conv"))).alias("end_conv"),
        F.first("ua").alias("ua"), F.first("ub").alias("ub"), F.first("bytes").alias("bytes"), F.first("total").alias("total"))
    nodes = materialize(nodes, "nodes")
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("ua").alias("ka"), F.col("ub").alias("kb")).agg(F.count(F.lit(1)).alias("n_children"))
    return materialize(nodes.join(children, NODE, "left").fillna(0, ["n_children"]).drop("ua", "ub"), "nodes")


class Parentheses:
    """Balanced parentheses (1 opens, 0 closes) with the least and largest excess of blocks, under a binary tree."""

    def __init__(self, bits: np.ndarray):
        self.excess = np.cumsum(2 * bits.astype(np.int32) - 1)
        padded = np.concatenate([self.excess, np.full(-len(bits) % BLOCK, self.excess[-1] if len(bits) else 0, self.excess.dtype)]).reshape(-1, BLOCK)
        self.low, self.high = [padded.min(axis=1)], [padded.max(axis=1)]
        while len(self.low[-1]) > 1:
            even = -(-len(self.low[-1]) // 2) * 2
            pairs = lambda x, fill: np.concatenate([x, np.full(even - len(x), fill, x.dtype)]).reshape(-1, 2)
            low, high = pairs(self.low[-1], np.iinfo(np.int32).max), pairs(self.high[-1], np.iinfo(np.int32).min)
            self.low.append(low.min(axis=1))
            self.high.append(high.max(axis=1))

    def scan(self, at: np.ndarray, target: np.ndarray, found: np.ndarray, who: np.ndarray) -> np.ndarray:
        """Look for the excess ``target`` from ``at`` to the end of its block; sets found[who], returns those without."""
        left, at, target = who, at.copy(), target
        lost = []
        while len(left):
            hit = self.excess[at] == target
            found[left[hit]] = at[hit]
            at, target, left = at[~hit] + 1, target[~hit], left[~hit]
            over = (at % BLOCK == 0) | (at >= len(self.excess))
            lost.append(left[over])
            at, target, left = at[~over], target[~over], left[~over]
        return np.concatenate(lost) if lost else left

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """The place that closes each of ``opens``: the first after it with an excess of one less than at it."""
        target = self.excess[opens] - 1
        found = np.full(len(opens), -1, np.int64)
        first = opens + 1
        inside = first % BLOCK != 0
        who = np.arange(len(opens))
        left = np.concatenate([self.scan(first[inside], target[inside], found, who[inside]), who[~inside]])
        # climb from the block until a block to the right, under the same parent, has the excess
        node, level, chosen = opens[left] // BLOCK, np.zeros(len(left), np.int64), np.full(len(left), -1, np.int64)
        for k in range(len(self.low)):
            open_ = chosen < 0
            beside = node + 1
            can = open_ & (node % 2 == 0) & (beside < len(self.low[k]))
            b = np.where(can, beside, 0)
            can &= (self.low[k][b] <= target[left]) & (target[left] <= self.high[k][b])
            chosen[can], level[can] = beside[can], k
            node = np.where(chosen < 0, node // 2, node)
        # and go down to the first block that has it
        for k in range(len(self.low) - 1, 0, -1):
            here = level == k
            child = chosen[here] * 2
            has = (self.low[k - 1][child] <= target[left[here]]) & (target[left[here]] <= self.high[k - 1][child])
            chosen[here], level[here] = np.where(has, child, child + 1), k - 1
        self.scan(chosen * BLOCK, target[left], found, left)
        return found


def shard(bounds: np.ndarray, conv: np.ndarray, leaf: np.ndarray, f: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Rows for the nodes of a shard: NODE, n_leaves and saved of what is owned here, and the upper end of the node's edge.

    Path i, of the conversation conv[i], has the kept nodes bounds[i]:bounds[i+1] of ``f`` (depth, ka, kb, n, conv,
    total); leaf[i]: no conversation goes on from its end."""
    size = np.diff(bounds)
    path = np.repeat(np.arange(len(size)), size)
    at = np.arange(bounds[-1]) - bounds[path]
    # how many nodes a path has in common with the one before
    prior = np.maximum(path - 1, 0)
    there = (path > 0) & (at < size[prior])
    j = np.where(there, bounds[prior] + at, 0)
    same = there & (f["ka"] == f["ka"][j]) & (f["kb"] == f["kb"][j])
    common = np.minimum.reduceat(np.where(same, bounds[-1], at), bounds[:-1])
    opened = at >= common[path]
    # closing and opening parentheses by turns
    counts = np.empty(2 * len(size), np.int64)
    counts[0::2], counts[1:-1:2], counts[-1] = size - common, size[:-1] - common[1:], size[-1]
    bits = np.repeat(np.tile(np.array([1, 0], np.int8), len(size)), counts)
    opens = np.flatnonzero(bits)
    close = Parentheses(bits).find_close(opens)
    # the node of each place of a path: the last one opened at its level
    number = np.cumsum(opened) - 1
    by_level = np.argsort(at, kind="stable")
    last = np.maximum.accumulate(np.where(opened[by_level], np.arange(len(at)), 0))
    node = np.empty(len(at), np.int64)
    node[by_level] = number[by_level][last]
    first = np.flatnonzero(opened)
    up = np.where(at > 0, np.arange(len(at)) - 1, 0)
    rooted = at == 0
    before = {"up_depth": np.where(rooted, -1, f["depth"][up]), "up_conv": f["conv"][up], "up_total": np.where(rooted, 0, f["total"][up])}
    # what a node saves, where its smallest conversation is; subtrees are runs of nodes in preorder
    owned = np.zeros(len(first), bool)
    owned[node[f["conv"] == conv[path]]] = True
    value = np.where(owned, ((f["n"] - 1) * (f["total"] - before["up_total"]))[first], 0)
    saved = np.concatenate([[0], np.cumsum(value)])
    below = (close - opens + 1) // 2
    k = np.arange(len(first))
    ends_whole = np.zeros(len(first), bool)
    ends_whole[node[bounds[1:] - 1]] = leaf
    pair = np.zeros(len(bits) + 1, np.int64)
    pair[opens + 1] = (bits[np.minimum(opens + 1, len(bits) - 1)] == 0) & ends_whole
    rank = np.cumsum(pair)  # leaf pairs that open before each place
    return {**{c: f[c][first] for c in NODE}, **{c: x[first] for c, x in before.items()},
            "n_leaves": rank[close] - rank[opens], "saved": saved[k + below] - saved[k]}


SHARD = "depth long, ka long, kb long, up_depth long, up_conv long, up_total long, n_leaves long, saved long"


def subtree_sums(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Kept nodes with n_leaves, saved (over the node's whole edge and subtree) and the upper end of its edge."""
    kept = nodes.filter("ends > 0 or n_children <> 1")
    only = nodes.filter("ends > 0").select(F.col("end_conv").alias("conv"))  # one of equal conversations
    fields = ["depth", "ka", "kb", "n", "conv", "total"]
    on_path = prefixes.select("conv", *NODE, "last").join(only, "conv", "left_semi").join(
        kept.select(*NODE, F.col("n_convs").alias("n"), F.col("conv").alias("least"), "total", (F.col("n_convs") == F.col("ends")).alias("leaf")), NODE)
    paths = on_path.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("depth", "ka", "kb", "n", F.col("least").alias("conv"), "total"))).alias("path"),
        F.bool_or(F.col("last") & F.col("leaf")).alias("leaf"))
    paths = paths.select(F.col("conv").alias("id"), "leaf", F.transform("path", lambda x: F.struct(x["ka"], x["kb"])).alias("order"), *(F.col(f"path.{c}").alias(c) for c in fields))

    def run(batches):
        for b in batches:
            if b.num_rows:
                lists = b.column("depth")
                bounds = lists.offsets.to_numpy().astype(np.int64)
                f = {c: b.column(c).flatten().to_numpy() for c in fields}
                rows = shard(bounds - bounds[0], b.column("id").to_numpy(), b.column("leaf").to_numpy(zero_copy_only=False), f)
                yield pa.RecordBatch.from_pydict({c: pa.array(x.astype(np.int64)) for c, x in rows.items()}, pa.schema([(c.split()[0], pa.int64()) for c in SHARD.split(", ")]))

    dealt = paths.repartitionByRange("order").sortWithinPartitions("order").drop("order")
    parts = dealt.mapInArrow(run, SHARD)
    # the shared spines of shards add up; the edge above a node is the same in all
    merged = parts.groupBy(*NODE).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), *(F.first(c).alias(c) for c in ("up_depth", "up_conv", "up_total")))
    return kept.join(merged, NODE)


def ends_digests(prefixes: DataFrame) -> DataFrame:
    """NODE and ends_sha256 for the nodes where conversations end: SHA-256 of their ids, ascending, with commas.

    Ids travel in pieces of a range of ids; a task reads the pieces of a node in order and holds one at a time."""
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string"))
    pieces = prefixes.filter("last").groupBy(*NODE, F.floor(F.col("conv") / PIECE).alias("piece")).agg(F.array_join(ids, ",").alias("ids"))

    def run(batches):
        key, digest = None, None
        for b in batches:
            out = []
            for *node, part in zip(*(b.column(c).to_pylist() for c in [*NODE, "ids"]), strict=True):
                if node == key:
                    digest.update(b"," + part.encode())
                else:
                    if key is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = node, hashlib.sha256(part.encode())
            yield batch(out)
        if key is not None:
            yield batch([(*key, digest.hexdigest())])

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string() if i == 3 else pa.int64()) for i in range(4)], [*NODE, "ends_sha256"])

    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece").mapInArrow(run, "depth long, ka long, kb long, ends_sha256 string")


def trie(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per node of the trie of the conversations ``convs`` (conv, length) with the turns ``rows`` (conv, depth, role, sha, bytes):
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    prefixes = prefix_rows(convs, rows)
    nodes = node_rows(prefixes)
    kept = subtree_sums(prefixes, nodes).join(ends_digests(prefixes), NODE, "left")
    # an edge stands for the nodes from below its upper end to its lower end; all have the same members
    steps = kept.select(F.col("depth").alias("low"), "n_convs", "conv", "n_children", "n_leaves", "saved", "up_depth", "up_conv", "up_total", "ends_sha256",
                        F.explode(F.sequence(F.col("up_depth") + 1, F.col("depth"), F.lit(RUN).cast("long"))).alias("from"))
    steps = steps.select("*", F.explode(F.sequence("from", F.least(F.col("from") + RUN - 1, F.col("low")))).alias("depth"))
    out = steps.join(nodes.select("conv", "depth", (F.col("total") - F.col("bytes")).alias("above")), ["conv", "depth"])
    lowest = F.col("depth") == F.col("low")
    return out.select(
        F.col("conv").alias("conv_id"), "depth",
        F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") == F.col("up_depth") + 1, F.col("up_conv")).otherwise(F.col("conv")).cast("long").alias("parent_conv_id"),
        "n_convs", F.when(lowest, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved") - (F.col("n_convs") - 1) * (F.col("above") - F.col("up_total"))).alias("saved_tokens"),
        F.when(lowest & F.col("ends_sha256").isNotNull(), F.col("ends_sha256")).otherwise(F.sha2(F.lit(""), 256)).alias("ends_sha256"))
