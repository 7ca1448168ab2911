"""Near duplicates by ProbMinHash over weighted word shingles.

Each shingle (five words; weight: its count in the text) is a Poisson process whose rate
is its weight. Arrivals go in time order to one of ``m`` random components, a component
keeps the first shingle to arrive, and a text is done when all its components have one no
later than the next arrivals. Two texts agree in a component with the probability of
their probability Jaccard. Components are banded; texts that share a band are candidates:

1. each bucket's texts against the bucket's smallest, verified exactly;
2. texts of a bucket that these links leave in different components meet with their shingles
   in blocks of bounded size; pairs whose signatures agree well enough are verified exactly
   there, and only links leave the block. Texts of one component need no further check.

Exact copies are one class from the start, so a group of copies is one text here.
Verification computes the probability Jaccard of the whole texts, on all shingles.

Defined results: a text without a shingle (null, empty or under five words) is near only
to equal texts, and an empty one to none; a null id is largest; repeated rows are copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import MIX, grams, hashes, mix, row_of, slices, two_columns, whole_groups, word_table
from strata.llm.components import connected_components
from strata.session import materialize

COMPONENTS, BAND = 64, 4
ROW_BITS = np.uint64(14)
BLOCK = 512


def shingles(words: pa.Array, at: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (row, 50-bit shingle, count), by row and shingle."""
    g = grams(hashes(words)[at], n)
    row = row_of(bounds)[:len(g)]
    inside = np.arange(len(g)) + n <= bounds[row + 1]
    key = np.sort((row[inside].astype(np.uint64) << (np.uint64(64) - ROW_BITS)) | (g[inside] >> ROW_BITS))
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate([head, [len(key)]]))
    key = key[head]
    return (key >> (np.uint64(64) - ROW_BITS)).astype(np.int64), key & ((np.uint64(1) << (np.uint64(64) - ROW_BITS)) - np.uint64(1)), count


def signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n_rows: int, m: int) -> np.ndarray:
    """(n_rows, m) winners' fingerprints; 0 where a row has no element."""
    first = np.full(n_rows * m, np.inf)
    winner = np.zeros(n_rows * m, np.uint32)
    last = np.full(n_rows, np.inf)  # latest first arrival of each row
    time, step = np.zeros(len(row)), 0
    while len(row):
        x = mix(element + np.uint64(int(MIX) * (2 * step + 1) % 2 ** 64))
        time = time - np.log(((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weight
        slot = row * m + (mix(x) % np.uint64(m)).astype(np.int64)
        early = time < last[row]
        row, element, weight, time, slot = row[early], element[early], weight[early], time[early], slot[early]
        np.minimum.at(first, slot, time)
        won = first[slot] == time
        winner[slot[won]] = (mix(element[won]) >> np.uint64(32)).astype(np.uint32)
        last = first.reshape(n_rows, m).max(axis=1)
        early = time < last[row]
        row, element, weight, time = row[early], element[early], weight[early], time[early]
        step += 1
    return winner.reshape(n_rows, m)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact similarity of two weighted sets (sorted distinct elements, weights)."""
    (x, wx), (y, wy) = a, b
    if not len(x) or not len(y):
        return 0.0
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if wx.max() == 1 and wy.max() == 1:
        return len(i) / (len(x) + len(y) - len(i))
    kinds, n = np.unique(np.stack([wx[i], wy[j]]), axis=1, return_counts=True)
    only_a, only_b = wx.sum() - wx[i].sum(), wy.sum() - wy[j].sum()
    p, q = kinds.astype(np.float64)
    both = np.maximum(p[None, :] / p[:, None], q[None, :] / q[:, None]) @ n
    return float((n / (both + only_a / p + only_b / q)).sum())


def signature_rows(docs: DataFrame, id_col: str, text_col: str, words: int, m: int) -> DataFrame:
    """One small row per document, written once: row, id, key, text_key, sha, size, sig (null without a shingle)."""
    def run(batches):
        for b in slices(batches, most_rows=1 << int(ROW_BITS)):
            row, element, count = shingles(*word_table(b.column("text")), words)
            has = np.bincount(row, minlength=b.num_rows) > 0
            sig = signatures(row, element, count.astype(np.float64), b.num_rows, m)
            sig = pa.array([x.tobytes() if k else None for x, k in zip(sig, has.tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [sig], [*keep, "sig"])
    text = F.col("text")
    src = two_columns(docs, id_col, text_col).select(
        "id", F.coalesce(F.col("id").cast("long"), F.lit(2 ** 63 - 1)).alias("key"), F.xxhash64(text).alias("text_key"),
        F.unhex(F.sha2(text, 256)).alias("sha"), F.octet_length(text).alias("size"), "text")
    keep = ["id", "key", "text_key", "sha", "size"]
    kind = ", ".join(f"{c} {src.schema[c].dataType.simpleString()}" for c in keep)
    return materialize(src.mapInArrow(run, kind + ", sig binary").withColumn("row", F.monotonically_increasing_id()), "signatures")


def texts_of(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, text) of the given nodes (node, key, text_key), written once."""
    src = two_columns(docs, id_col, text_col).select(
        F.coalesce(F.col("id").cast("long"), F.lit(2 ** 63 - 1)).alias("key"), F.xxhash64("text").alias("text_key"), "text")
    return materialize(src.join(nodes, ["key", "text_key"]).select("node", "text").dropDuplicates(["node"]), "texts")


def verify(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, words: int, threshold: float) -> DataFrame:
    """Pairs (a, b) whose exact similarity is at least ``threshold``, written once."""
    pairs = materialize(pairs.select("a", "b").distinct(), "pairs")
    used = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = texts_of(docs, nodes.join(used, "node"), id_col, text_col)

    def run(batches):
        for b in slices(batches, "text_b"):
            sides = []
            for side in "ab":
                row, element, count = shingles(*word_table(b.column(f"text_{side}")), words)
                edge = np.searchsorted(row, np.arange(b.num_rows + 1))
                sides.append((element, count, edge))
            good = []
            for i in range(b.num_rows):
                one, two = ((e[s[i]:s[i + 1]], c[s[i]:s[i + 1]]) for e, c, s in sides)
                good.append(probability_jaccard(one, two) >= threshold)
            yield b.select(["a", "b"]).filter(pa.array(good))

    both = (pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b"))
    return materialize(both.mapInArrow(run, "a long, b long"), "links")


def stars(members: DataFrame) -> DataFrame:
    """Every text of a bucket with the bucket's smallest."""
    least = members.groupBy("band", "part").agg(F.min("node").alias("a"), F.count("*").alias("n")).filter("n > 1")
    return members.join(least, ["band", "part"]).filter("node <> a").select("a", F.col("node").alias("b")).distinct()


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """(node, elements, counts) of texts (node, text), written once; counts is empty where all are 1."""
    def run(batches):
        for b in slices(batches, most_rows=1 << int(ROW_BITS)):
            row, element, count = shingles(*word_table(b.column("text")), words)
            edge = np.searchsorted(row, np.arange(b.num_rows + 1))
            parts = [(element[s:e], count[s:e]) for s, e in zip(edge[:-1], edge[1:], strict=True)]
            sets = [x.tobytes() for x, _ in parts]
            counts = [c.astype(np.uint32).tobytes() if len(c) and c.max() > 1 else b"" for _, c in parts]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(sets, pa.binary()), pa.array(counts, pa.binary())], ["node", "elements", "counts"])
    return materialize(texts.select("node", "text").mapInArrow(run, "node long, elements binary, counts binary"), "sets")


class Cell:
    """Rows of one pair of blocks of a bucket; finds links between components."""

    def __init__(self, t: pa.Table, s: int, e: int, m: int, band: int):
        t = t.slice(s, e - s)
        self.node, self.comp, self.least, own, other = (t.column(c).to_numpy() for c in ("node", "component", "least", "own", "other"))
        self.band, self.size, self.width = t.column("band")[0].as_py(), band, m
        self.sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint32).reshape(-1, m)
        self.sets, self.counts = t.column("elements"), t.column("counts")
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.x, self.y = np.flatnonzero(own <= other), np.flatnonzero(own > other)

    def bag(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self.known:
            x, c = np.frombuffer(self.sets[i].as_py(), np.uint64), np.frombuffer(self.counts[i].as_py(), np.uint32).astype(np.int64)
            self.known[i] = (x, c if len(c) else np.ones(len(x), np.int64))
        return self.known[i]

    def links(self, threshold: float, enough: float):
        """One link, if any, of each row with each other component; candidates in order of their agreement."""
        alone = not len(self.y)  # a block with itself, or with an empty one
        for i in self.x[self.node[self.x] != self.least[self.x]].tolist():
            z = self.x[self.x > i] if alone else self.y
            z = z[(self.comp[z] != self.comp[i]) & (self.node[z] != self.least[z])]
            same = self.sig[z] == self.sig[i]
            # a pair is tried in the first band that it shares
            before = same.reshape(len(z), self.width // self.size, self.size).all(axis=2)[:, :self.band].any(axis=1)
            agree = same.mean(axis=1)
            order = np.argsort(-agree, kind="stable")
            done = set()
            for j in z[order[(agree >= enough)[order] & ~before[order]]].tolist():
                if self.comp[j] not in done and probability_jaccard(self.bag(i), self.bag(j)) >= threshold:
                    done.add(self.comp[j])
                    yield self.node[i], self.node[j]


def links_between(members: DataFrame, component: DataFrame, docs: DataFrame, places: DataFrame, id_col: str, text_col: str,
                  words: int, m: int, band: int, threshold: float) -> DataFrame:
    """Links of texts of a bucket that are still in different components, written once; the stars' pairs were tried.

    Pairs whose signatures agree nearly as ``threshold`` asks are verified where they meet, so that
    only links leave a block."""
    at = members.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = at.groupBy("band", "part").agg(
        F.min("node").alias("least"), F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("n"),
    ).filter("c0 <> c1 and n > 2")
    dealt = materialize(at.join(mixed, ["band", "part"]).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).select(
        "band", "part", "node", "component", "least", "sig", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own")), "mixed")
    sets = shingle_sets(texts_of(docs, places.join(dealt.select("node").distinct(), "node"), id_col, text_col), words)
    # a block meets each other block once: in the group named by (smaller, larger)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(sets, "node").select(
        F.xxhash64("band", "part", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
        "band", "own", "other", "node", "component", "least", "sig", "elements", "counts")
    enough = threshold - 4 * np.sqrt(threshold * (1 - threshold) / m)

    def run(batches):
        for t in whole_groups(batches, "cell"):
            cell = t.column("cell").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]]).tolist()
            found = [x for s, e in zip(edges[:-1], edges[1:], strict=True) for x in Cell(t, s, e, m, band).links(threshold, enough)]
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return materialize(dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    threshold: float = 0.8, m: int = COMPONENTS, band: int = BAND) -> DataFrame:
    """One row per document: id, class_id (smallest id of its class), class_size, kept (one row of each class), text_key (xxhash64)."""
    rows = signature_rows(docs, id_col, text_col, words, m)
    copies = rows.filter("size > 0").groupBy("sha").agg(
        F.min(F.struct("key", "row", "text_key")).alias("least"), F.any_value("sig").alias("sig"))
    nodes = materialize(copies.select(F.col("least.row").alias("node"), "least.key", "least.text_key", "sha", "sig"), "nodes")
    members = nodes.filter("sig is not null").select("node", "sig", F.explode(F.sequence(F.lit(0), F.lit(m // band - 1))).alias("band"))
    members = members.withColumn("part", F.substring("sig", F.col("band") * (4 * band) + 1, F.lit(4 * band)))
    places = nodes.select("node", "key", "text_key")
    links = verify(stars(members.select("node", "band", "part")), places, docs, id_col, text_col, words, threshold)
    rest = links_between(members, connected_components(links), docs, places, id_col, text_col, words, m, band, threshold)
    component = connected_components(links.union(rest))
    of_copy = nodes.join(component, "node", "left").select("sha", F.coalesce("component", "node").alias("component"))
    tagged = rows.join(of_copy, "sha", "left").withColumn("component", F.coalesce("component", "row"))
    classes = tagged.groupBy("component").agg(F.min(F.struct("key", "row", "id")).alias("least"), F.count("*").alias("class_size"))
    return tagged.join(classes, "component").select(
        F.col("id").alias(id_col), F.col("least.id").alias("class_id"), "class_size", (F.col("row") == F.col("least.row")).alias("kept"), "text_key")
