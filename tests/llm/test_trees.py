"""The prefix trie and the Merkle manifest against plain restatements."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import merkle, prefix_trie
from strata.llm.common import numbered, remainder

sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
TURNS = "conv_id long, turn int, role string, text string, conv string, rank string, depth string, ka string, size string"


# ---- prefix trie --------------------------------------------------------------
def plain_trie(rows, head=lambda c: c - c % 5, heads=lambda c: zlib.crc32(str(c).encode()) % 9):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", sha(text or ""), text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(x)] for c, x in own.items()}
    rebuilt = {c: tuple(own.get(head(c), [])[:heads(c)] + x[heads(c):]) for c, x in own.items()}
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(int)
    for p in members:
        children[p[:-1]] += len(p) > 0
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = sorted(c for c in m if len(rebuilt[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], sum(not children[q] for q in below), saved, sha(",".join(map(str, ends)))))
    return sorted(out, key=str)


def trie_of(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", "z", "a", "b") for r in rows], TURNS)
    turns = prefix_trie.turn_rows(df)
    return prefix_trie.trie(*prefix_trie.share_heads(turns, F.col("conv") - F.col("conv") % 5, remainder("conv", 9)))


def random_conversations(seed):
    """Few texts, so that prefixes meet; copies, a long conversation, ends inside others, nulls, ties and repeated rows."""
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(400), 70):
        rows += [(c, i, rnd.choice(["user", "assistant", None]) if rnd.random() < 0.1 else "user", rnd.choice(["a", "bé", "ccc"])) for i in range(rnd.randint(1, 6))]
    for c in range(1000, 1012):  # copies of one conversation, and of its beginning
        rows += [(c, i, "user", f"t{i}") for i in range(14 if c % 2 else 11)]
    rows += [(2000, i, "user", f"t{i}" if i < 12 else f"own {i}") for i in range(300)]
    rows += [(2001, None, None, None), (2001, None, "user", ""), (2001, 3, "user", "x"), (2001, 3, "user", "x"), (2001, 3, "user", "w"), (None, 1, "user", "lost"), (-7, 0, "user", "n")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("batch,run", [(10_000, 4096), (3, 8)])
def test_trie(spark, monkeypatch, batch, run):
    """Also in shards of three conversations, whose spines are shared, and with turns summed up in runs of eight."""
    rows = random_conversations(batch)
    monkeypatch.setattr(prefix_trie, "RUN", run)
    monkeypatch.setattr(prefix_trie, "PIECE", run)
    want = plain_trie(rows, head=lambda c: c - int(np.fmod(c, 5)))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        assert sorted(map(tuple, trie_of(spark, rows).collect()), key=str) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_trie_edges(spark):
    assert trie_of(spark, []).collect() == [] == trie_of(spark, [(None, 1, "user", "x")]).collect()
    one = [(5, 0, "user", "x")]
    assert sorted(map(tuple, trie_of(spark, one).collect()), key=str) == plain_trie(one)
    # a conversation that is rebuilt without any turn ends at the root
    turnless = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(turnless, 0, "user", "x"), (200, 0, "user", "y")]
    assert sorted(map(tuple, trie_of(spark, rows).collect()), key=str) == plain_trie(rows)


def test_find_close(monkeypatch):
    rnd = random.Random(1)
    for block in (4, 16, 256):
        monkeypatch.setattr(prefix_trie, "BLOCK", block)
        for _ in range(40):
            bits, depth, stack, want = [], 0, [], {}
            for _ in range(rnd.randint(1, 300)):
                up = depth == 0 or rnd.random() < rnd.choice([0.2, 0.5, 0.9])
                if up:
                    stack.append(len(bits))
                else:
                    want[stack.pop()] = len(bits)
                bits.append(int(up))
                depth += 1 if up else -1
            while stack:
                want[stack.pop()] = len(bits)
                bits.append(0)
            opens = np.flatnonzero(bits)
            assert prefix_trie.Parentheses(np.array(bits, np.int8)).find_close(opens).tolist() == [want[i] for i in opens.tolist()]


# ---- Merkle manifest ------------------------------------------------------------
DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, digest string, rank int, path string, height int"


def plain_manifest(rows):
    def h(*fields):
        return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))

    def fold(level):
        """(root, siblings of each from below, places of each)"""
        beside = [[] for _ in level]
        of = [[i] for i in range(len(level))]
        while len(level) > 1:
            up, above = [], []
            for at in range(0, len(level), 8):
                run = level[at:at + 8]
                for i in range(len(run)):
                    for leaf in of[at + i]:
                        beside[leaf].append(("".join(run[:i]), "".join(run[i + 1:])))
                up.append(sha("".join(run)))
                above.append([x for y in of[at:at + 8] for x in y])
            level, of = up, above
        return level[0], beside

    trees = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        hit = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 3 == 0 and text is not None
        seen = "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if hit else text
        leaf = h(doc_id, source, lang, n_chars, text)
        trees[lang].append(((doc_id is not None, doc_id or 0, leaf), leaf, h(doc_id, source, lang, n_chars, seen)))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    lower = {n: fold([leaf for _, leaf, _ in sorted(trees[n])]) for n in names}
    root, tops = fold([lower[n][0] for n in names]) if names else (None, [])
    out = []
    for n, top in zip(names, tops, strict=True):
        subroot, beside = lower[n]
        for (key, leaf, found), mine in zip(sorted(trees[n]), beside, strict=True):
            at, path = found, mine + top
            for left, right in path:
                at = sha(left + at + right)
            out.append((key[1] if key[0] else None, leaf, subroot, root, sha("".join(x + y for x, y in path)), at, at == root))
    return sorted(out, key=str)


def manifest_of(spark, rows):
    docs = spark.createDataFrame([(*r, "t", "d", 1, "p", 2) for r in rows], DOCS)
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    found = [*fields[:-1], F.when(remainder("doc_id", 3) == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))]
    return merkle.prove(docs, fields, found)


def test_manifest(spark):
    """Trees of 1, 8, 9, 65 and more leaves, more than eight trees, nulls, ties and repeated rows."""
    rnd = random.Random(4)
    rows = [(i, f"Text {i} É", lang, "s", i) for lang, n in (("a", 1), ("b", 8), ("c", 9), ("ü", 65), (None, 130), ("", 2), ("d", 3), ("e", 16), ("f", 17), ("g", 1)) for i in range(n)]
    rows += [(None, "NULL id", "c", None, None), (3, None, "c", "s", None), (3, "Text 3 É", "c", "s", 3), *[(7, "Same", "d", "s", 4)] * 20]
    rnd.shuffle(rows)
    got = manifest_of(spark, rows)
    assert sorted((tuple(r) for r in got.drop("path").collect()), key=str) == plain_manifest(rows)
    assert {r.verified for r in got.collect()} == {True, False}


def test_manifest_edges(spark):
    assert manifest_of(spark, []).collect() == []
    for rows in ([(1, "X", "a", "s", 1)], [(1, "X", None, "s", 1), (2, "Y", "a", "s", 1)], [(i, "X", "a", "s", 1) for i in range(9)]):
        assert sorted((tuple(r) for r in manifest_of(spark, rows).drop("path").collect()), key=str) == plain_manifest(rows)


def test_descent_to_some_leaves(spark):
    """Asked for a few leaves, the descent reaches their runs only."""
    leaves = spark.range(600).select(F.lit("t").alias("tree"), F.col("id").alias("rank"), F.lit(600).cast("long").alias("size"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    forest = merkle.build(leaves)
    starts = forest.roots.withColumn("path", F.array().cast(merkle.SEGMENTS))
    wanted = spark.createDataFrame([("t", 5), ("t", 6), ("t", 599)], "tree string, rank long")
    got = {r.run: r for r in merkle.descend(forest, starts, wanted).collect()}
    assert sorted(got) == [0, 74] and len(merkle.descend(forest, starts).collect()) == 75
    root = forest.roots.first().digest
    for rank in (5, 599):
        r = got[rank // 8]
        at, i = sha(str(rank)), rank % 8
        for left, right in [("".join(r.children[:i]), "".join(r.children[i + 1:])), *reversed(r.path)]:
            at = sha(left + at + right)
        assert at == root


def test_numbering_of_a_hot_group(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.when(F.col("id") % 2 > 0, F.col("id").cast("string"))).alias("g"), F.col("id").alias("v"))
    got = defaultdict(list)
    for r in numbered(rows, ["g"], ["v"], "numbers").collect():
        got[r.g].append((r.v, r["rank"], r["size"]))
    for x in got.values():
        assert [(rank, size) for _, rank, size in sorted(x)] == [(i, len(x)) for i in range(len(x))]
