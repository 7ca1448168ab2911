"""Near-duplicate vectors by NN-descent.

Equal vectors of a label are one node. A neighbour graph of ``k`` neighbours a node starts
from small groups (random ones, and ones that share the signs of random projections) and is
refined by rounds of neighbours-of-neighbours joins: the neighbours and a bounded random
choice of the reverse neighbours of a node meet in one group and compare with each other,
if one of them is new to the node; a node keeps its ``k`` best. Rounds end once few lists
change. Pairs above the threshold are checked again in double precision.

A list full of neighbours above the threshold is saturated: more links may exist. It is
enlarged to all links of the node's component: the component's nodes compare with each
other in double precision, in blocks of bounded size, which emit counts only.

An audit compares bounded samples of nodes (``AUDIT`` with saturated components, as many others, and as many others
whose best neighbour is at most ``NEAR`` below the threshold, so that rare links are met; lowest hashes) with all others
of their label. Its recall is the mean over the nodes of a sample of the share of linked nodes that was found, the
smaller of the saturated and other samples'; null where no sampled node has a link, and nothing was measured.
While it is below ``RECALL``, ``k`` is doubled, groups by fresh projections are added and the
descent goes on; after ``TRIES`` descents all nodes of a label compare in blocks.

Defined results: vectors that are null, zero or hold null or non-finite components, or
have no label, link with nothing; vectors of different length don't either; repeated rows
are vectors of their own; a null id is never the smallest of a component that has another.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import whole_groups
from strata.llm.components import connected_components
from strata.session import materialize

GROUP = 64  # nodes in a group of the first graph, on average
TABLES = 6  # groupings by projections; two random ones come on top
BLOCK = 512
AUDIT, RECALL, TRIES, NEAR = 512, 0.98, 3, 0.1
EDGES = "a long, b long, sim float"


def matrix(values: list[bytes], kind=np.float32) -> np.ndarray:
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def groups(batches, key: str):
    """(start, end, table) of each group of a partition sorted by ``key``."""
    for t in whole_groups(batches, key):
        k = t.column(key).to_numpy()
        edge = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        yield t, list(zip(edge[:-1], edge[1:], strict=True))


def best_pairs(unit: np.ndarray, allowed: np.ndarray, worst: np.ndarray, k: int):
    """For each row its ``k`` most similar others among the allowed, if better than ``worst``: (row, other, similarity)."""
    s = unit @ unit.T
    s[~allowed] = -2
    s[s <= worst[:, None]] = -2
    if s.shape[1] > k:
        top = np.argpartition(-s, k - 1, axis=1)[:, :k]
    else:
        top = np.broadcast_to(np.arange(s.shape[1]), s.shape)
    i, j = np.repeat(np.arange(len(s)), top.shape[1]), top.reshape(-1)
    good = s[i, j] > -2
    return i[good], j[good], s[i, j][good]


def compare_groups(rows: DataFrame, key: str, k: int) -> DataFrame:
    """Candidate edges within the groups of ``rows`` (key, node, unit, worst, fresh): pairs with a fresh member."""
    def run(batches):
        for t, spans in groups(batches, key):
            node, worst, fresh = (t.column(c).to_numpy() for c in ("node", "worst", "fresh"))
            unit = t.column("unit").to_pylist()
            a, b, sim = [], [], []
            for s, e in spans:
                if e - s < 2:
                    continue
                allowed = fresh[s:e, None] | fresh[None, s:e]
                np.fill_diagonal(allowed, False)
                i, j, x = best_pairs(matrix(unit[s:e]), allowed, worst[s:e], k)
                a.append(node[s + i])
                b.append(node[s + j])
                sim.append(x)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b, sim)], ["a", "b", "sim"])
    rows = rows.select(F.col(key).alias("key"), "node", "unit", "worst", "fresh")
    key = "key"
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, EDGES)


def valid_nodes(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows: row, id, node or null; nodes: node, part, label, n (nodes of the label and length), copies, exact, unit)."""
    v = F.col("v")
    good = (F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))

    def units(batches):
        for b in batches:
            exact = []
            for x in b.column("v"):
                if not x.is_valid:
                    exact.append(None)
                    continue
                x = x.values.to_numpy().astype(np.float64)
                x = x / np.abs(x).max()
                exact.append((x / np.sqrt(x @ x)).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(exact, pa.binary())], ["id", "label", "exact"])
    src = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    src = src.withColumn("v", F.when(good, v))
    kinds = [src.schema[c].dataType.simpleString() for c in ("id", "label")]
    rows = materialize(src.mapInArrow(units, f"id {kinds[0]}, label {kinds[1]}, exact binary").withColumn("row", F.monotonically_increasing_id()), "vectors")
    same = rows.filter("exact is not null").groupBy("label", "exact").agg(F.min("row").alias("node"), F.count("*").alias("copies"))
    part = F.xxhash64("label", F.length("exact"))
    same = materialize(same.withColumn("part", part), "nodes")
    size = same.groupBy("part").agg(F.count("*").alias("n"))

    def short(batches):
        for b in batches:
            unit = [np.frombuffer(x, np.float64).astype(np.float32).tobytes() for x in b.column("exact").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(unit, pa.binary())], [*b.schema.names, "unit"])
    nodes = same.join(size, "part").select("node", "part", "label", "n", "copies", "exact")
    nodes = materialize(nodes.mapInArrow(short, f"node long, part long, label {kinds[1]}, n long, copies long, exact binary, unit binary"), "units")
    return rows.join(same.select("label", "exact", "node"), ["label", "exact"], "left").select("row", "id", "node"), nodes


def first_graph(nodes: DataFrame, k: int, turn: int = 0) -> DataFrame:
    """Candidate edges from random groups and from groups by signs of random projections, both of bounded size; other ones at each ``turn``."""
    def coded(batches):
        for b in batches:
            n, unit = b.column("n").to_numpy(), b.column("unit").to_pylist()
            code = np.zeros((len(n), TABLES), np.int64)
            size = np.array([len(u) for u in unit]) // 4
            for d in np.unique(size).tolist():
                own = np.flatnonzero(size == d)
                sides = matrix([unit[i] for i in own]) @ np.random.default_rng([d, turn] if turn else d).standard_normal((d, TABLES * 20)).astype(np.float32) > 0
                bits = np.clip(np.ceil(np.log2(np.maximum(n[own] / GROUP, 1))), 0, 20).astype(np.int64)
                each = sides.reshape(len(own), TABLES, 20) & (np.arange(20) < bits[:, None])[:, None, :]
                code[own] = each @ (1 << np.arange(20))
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("part"), b.column("n"), pa.array(list(code), pa.list_(pa.int64()))], ["node", "part", "n", "code"])
    slim = nodes.select("node", "part", "n", "unit").mapInArrow(coded, "node long, part long, n long, code array<long>")
    signed = slim.select("node", F.posexplode("code"), "part").select("node", F.xxhash64("part", "pos", "col").alias("g"))
    chance = [slim.select("node", F.xxhash64("part", F.lit(-t), F.pmod(F.xxhash64("node", F.lit(t)), F.ceil(F.col("n") / GROUP))).alias("g")) for t in (2 * turn + 1, 2 * turn + 2)]
    dealt = materialize(signed.union(chance[0]).union(chance[1]), "groups")
    # a group of many is dealt at random into groups of about GROUP
    large = dealt.groupBy("g").agg(F.count("*").alias("size")).filter(F.col("size") > 2 * GROUP)
    parts = F.coalesce(F.ceil(F.col("size") / GROUP), F.lit(1))
    dealt = dealt.join(large, "g", "left").select("node", F.xxhash64("g", F.pmod(F.xxhash64("node", "g"), parts)).alias("g"))
    rows = dealt.join(nodes.select("node", "unit"), "node").withColumn("worst", F.lit(-2.0).cast("float")).withColumn("fresh", F.lit(True))
    return compare_groups(rows, "g", k)


def k_best(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` best neighbours of each a (a, b, sim, fresh); fresh: not among the old edges."""
    one = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("a").orderBy(F.desc("sim"), "b")
    return one.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).drop("place")


def descend(nodes: DataFrame, graph: DataFrame, k: int, rounds: int = 8, change: float = 0.005) -> DataFrame:
    """Rounds of neighbours-of-neighbours joins until few lists change."""
    n = nodes.count()
    for _ in range(rounds):
        chance = Window.partitionBy("b").orderBy(F.xxhash64("a", "b"))
        back = graph.withColumn("place", F.row_number().over(chance)).filter(F.col("place") <= k)
        met = (graph.select(F.col("a").alias("u"), F.col("b").alias("node"), "fresh")
               .union(back.select(F.col("b").alias("u"), F.col("a").alias("node"), "fresh"))
               .groupBy("u", "node").agg(F.max("fresh").alias("fresh")))
        # groups without a fresh member have nothing to compare
        live = graph.filter("fresh").select(F.explode(F.array("a", "b")).alias("u")).distinct()
        worst = graph.groupBy("a").agg(F.min("sim").alias("least"), F.count("*").alias("size"))
        known = nodes.select("node", "unit").join(worst.withColumnRenamed("a", "node"), "node", "left").select(
            "node", "unit", F.when(F.col("size") >= k, F.col("least")).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
        found = compare_groups(met.join(live, "u").join(known, "node"), "u", k)
        graph = materialize(k_best(graph.withColumn("fresh", F.lit(False)).unionByName(found.withColumn("fresh", F.lit(True))), k), "graph")
        if graph.filter("fresh").count() <= change * n * k:
            break
    return graph


def exact_links(graph: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Links (a < b) of the graph: same label and cosine of at least ``threshold`` in double precision."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                x, y = b.column("x").to_pylist(), b.column("y").to_pylist()
                cos = np.array([np.frombuffer(p) @ np.frombuffer(q) for p, q in zip(x, y, strict=True)])
                yield b.select(["a", "b"]).filter(pa.array(cos >= threshold))
    near = graph.filter(F.col("sim") >= threshold - 1e-4).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    one = nodes.select(F.col("node").alias("a"), F.col("exact").alias("x"), F.col("label").alias("la"))
    two = nodes.select(F.col("node").alias("b"), F.col("exact").alias("y"), F.col("label").alias("lb"))
    both = near.join(one, "a").join(two, "b").filter("la = lb").select("a", "b", "x", "y")
    return materialize(both.mapInArrow(run, "a long, b long"), "links")


def roots(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the first row it is connected with."""
    out = np.arange(len(near))
    for i in range(len(near)):
        if out[i] != i:
            continue
        reached = new = np.arange(len(near)) == i
        while new.any():
            new = near[new].any(axis=0) & ~reached
            reached = reached | new
        out[reached] = i
    return out


def count_in_blocks(members: DataFrame, threshold: float, connect: bool = False) -> DataFrame:
    """(node, others, linked): copies and number of all other nodes of its component that it links with; ``members``: node, component, label, copies, exact.

    With ``connect`` the rows of each block by themselves, and a node of the block that it is connected with as ``root``.
    """
    def run(batches):
        for t, spans in groups(batches, "cell"):
            node, copies, own, other = (t.column(c).to_numpy() for c in ("node", "copies", "own", "other"))
            exact = t.column("exact").to_pylist()
            for s, e in spans:
                x, y = s + np.flatnonzero(own[s:e] <= other[s:e]), s + np.flatnonzero(own[s:e] > other[s:e])
                alone = (own[s:e] == other[s:e]).all()
                y = x if alone else y
                if not len(x) or not len(y):
                    continue
                near = matrix([exact[i] for i in x], np.float64) @ matrix([exact[i] for i in y], np.float64).T >= threshold
                if alone:
                    np.fill_diagonal(near, False)
                out = [(node[x], near @ copies[y], near.sum(axis=1))] + ([] if alone else [(node[y], copies[x] @ near, near.sum(axis=0))])
                i, n, linked = (np.concatenate(c) for c in zip(*out, strict=True))
                root = i
                if connect and near.any():
                    both = near if alone else np.block([[np.zeros((len(x), len(x)), bool), near], [near.T, np.zeros((len(y), len(y)), bool)]])
                    root = i[roots(both)]
                some = linked > 0
                yield pa.RecordBatch.from_arrays([pa.array(c[some].astype(np.int64)) for c in (i, n, linked, root)], ["node", "others", "linked", "root"])
    size = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(size, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.xxhash64("component", "label", F.least("own", "other"), F.greatest("own", "other"))
    rows = dealt.select(cell.alias("cell"), "node", "copies", "exact", "own", "other")
    rows = rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "node long, others long, linked long, root long")
    return rows if connect else rows.groupBy("node").agg(F.sum("others").alias("others"), F.sum("linked").alias("linked"))


def count_links(links: DataFrame, graph: DataFrame, nodes: DataFrame, component: DataFrame, k: int, threshold: float) -> DataFrame:
    """(node, others, linked, saturated) with the lists of saturated nodes' components enlarged to all their links."""
    copies = nodes.select(F.col("node").alias("b"), "copies")
    both = links.union(links.select("b", "a"))
    plain = both.join(copies, "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("others"), F.count("*").alias("linked"))
    full = graph.groupBy("a").agg(F.count("*").alias("size"), F.min("sim").alias("least")).filter((F.col("size") >= k) & (F.col("least") >= threshold - 1e-4))
    dense = full.select(F.col("a").alias("node")).join(component, "node").select("component").distinct()
    members = component.join(dense, "component").join(nodes.select("node", "label", "copies", "exact"), "node")
    more = count_in_blocks(members, threshold)
    return plain.join(more.select("node", F.col("others").alias("all"), F.col("linked").alias("all_linked")), "node", "full").select(
        "node", F.coalesce("all", "others").alias("others"), F.coalesce("all_linked", "linked").alias("linked"), F.col("all").isNotNull().alias("saturated"))


def all_links(nodes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(component, counted) from all pairs of nodes of a label and length, in blocks."""
    members = nodes.select("node", F.col("part").alias("component"), "label", "copies", "exact")
    rows = materialize(count_in_blocks(members, threshold, connect=True), "blocks")
    component = connected_components(rows.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    counted = rows.groupBy("node").agg(F.sum("others").alias("others"), F.sum("linked").alias("linked")).withColumn("saturated", F.lit(False))
    return materialize(component, "component"), materialize(counted, "counted")


def audit(nodes: DataFrame, counted: DataFrame, threshold: float, graph: DataFrame) -> float | None:
    """Mean share of a node's linked nodes that was found, over a sample of nodes that have some: the smaller one of saturated nodes and others; None for none."""
    split = nodes.select("node", "label", "exact").join(counted.select("node", "saturated"), "node", "left").withColumn("saturated", F.coalesce("saturated", F.lit(False)))
    lowest = lambda df: df.orderBy(F.xxhash64("node"), "node").limit(AUDIT)
    near = graph.filter(F.col("sim") >= threshold - NEAR).select(F.col("a").alias("node")).distinct()
    close = lowest(split.filter("not saturated").join(near, "node", "left_semi"))
    sample = lowest(split.filter("not saturated")).union(lowest(split.filter("saturated"))).union(close).dropDuplicates(["node"])
    asked = nodes.sparkSession.sparkContext.broadcast(sample.toPandas().to_dict("list"))

    def run(batches):
        q = asked.value
        asks: dict[tuple, list[int]] = {}
        for i, key in enumerate(zip(q["label"], map(len, q["exact"]), strict=True)):
            asks.setdefault(key, []).append(i)
        for b in batches:
            label, exact = b.column("label").to_pylist(), b.column("exact").to_pylist()
            node = b.column("node").to_numpy()
            rows: dict[tuple, list[int]] = {}
            for j, key in enumerate(zip(label, map(len, exact), strict=True)):
                rows.setdefault(key, []).append(j)
            for key, ask in asks.items():
                if key in rows:
                    own, to = rows[key], np.array([q["node"][i] for i in ask])
                    near = matrix([exact[j] for j in own], np.float64) @ matrix([q["exact"][i] for i in ask], np.float64).T >= threshold
                    near &= node[own][:, None] != to[None, :]
                    yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(near.sum(axis=0).astype(np.int64))], ["node", "others"])
    true = nodes.select("node", "label", "exact").mapInArrow(run, "node long, others long").groupBy("node").agg(F.sum("others").alias("true")).filter(F.col("true") > 0)
    share = F.least(F.coalesce("linked", F.lit(0)), "true") / F.col("true")
    found = true.join(counted, "node", "left").groupBy(F.coalesce("saturated", F.lit(False))).agg(F.avg(share)).collect()
    return min((r[1] for r in found), default=None)


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 threshold: float = 0.93, k: int = 10) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept (id is the component's smallest), audit_recall."""
    rows, nodes = valid_nodes(vectors, id_col, vec_col, label_col)
    first = first_graph(nodes, k).withColumn("fresh", F.lit(True))
    graph = materialize(k_best(first, k), "graph")
    for attempt in range(TRIES):
        graph = descend(nodes, graph, k)
        links = exact_links(graph, nodes, threshold)
        component = materialize(connected_components(links), "component")
        counted = materialize(count_links(links, graph, nodes, component, k, threshold), "counted")
        recall = audit(nodes, counted, threshold, graph)
        if recall is None or recall >= RECALL:
            break
        if attempt == TRIES - 1:
            component, counted = all_links(nodes, threshold)
            recall = audit(nodes, counted, threshold, graph)
            break
        k *= 2
        more = first_graph(nodes, k, attempt + 1).withColumn("fresh", F.lit(True))
        graph = materialize(k_best(graph.withColumn("fresh", F.lit(True)).unionByName(more), k), "graph")
    own = nodes.select("node", "copies").join(counted, "node", "left").join(component, "node", "left").select(
        "node", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    tagged = materialize(rows.join(own, "node", "left").withColumn("component", F.coalesce("component", "row")), "tagged")
    least = tagged.groupBy("component").agg(F.min("id").alias("component_id"))
    return tagged.join(least, "component").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), F.lit(recall).cast("double").alias("audit_recall"))
