"""Toxicity of texts after noisy-channel deobfuscation.

1. A character trigram model is counted over all training texts (Spark sums the counts;
   ``CLASSES``^3 cells at most).
2. A word with leetspeak, separators or a letter three times in a row, and a row of three
   or more fragments (``FRAGMENT`` letters at most), becomes a lattice: for each character
   the letters it may stand for, or nothing; for each gap of a row no space or a word's
   edge. Viterbi search takes the path with the best channel cost plus model probability.
   Of a row, every word joined from fragments counts that is part of a reading at most
   ``MARGIN`` below the best, beside the words as written, and a row of single letters as
   one word. Other words stay as they are, without edge punctuation.
3. Restored words and their first letters are weighed by log odds of toxic against other
   labelled texts, learned on ``FIT_ROWS`` labelled texts at most (lowest hashes of the id;
   documented limit; whole texts). A feature counts once for each different word before
   it, so copies of a text don't make their words evidence. A logistic curve over the
   strongest weight and the number of strong words gives the score.

Defined results: a null or empty text has the score of a text without evidence; labels
that are null aren't learned; an id labelled twice has the larger label; with no labels of
one kind every score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

import functools
import itertools
import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import row_of, slices, word_table
from strata.session import materialize

FIT_ROWS = 20_000
FEATURES = 1 << 16
CONTEXTS = 5  # different words before a feature that make it evidence
STRONG = 2.0

# Letters of the character model: a to z, and the Latin-1 letters; any other letter is one
# class, anything else is the word's edge.
ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
CLASSES = len(ALPHABET) + 2
OTHER = CLASSES - 1
CLASS = {c: i + 1 for i, c in enumerate(ALPHABET)}

# Letters that a digit or sign is commonly written for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
EDGES = ".,;:!?\"'()[]{}%&#*~_-/\\"
SUBSTITUTED, DROPPED, SHORTENED = 2.0, 1.0, 0.5  # channel costs (natural logarithms)
JOINED = 1.0  # the same, of a gap that is no word's edge
FRAGMENT = 2  # letters
WORD = 32  # pieces of a word within a row; a row of single letters is read as one word besides, however long
MARGIN, BEAM = 4.0, 20.0
SUSPECT = r"[^\p{L}]"  # anything but letters
REPEATED = re.compile(r"(.)\1\1")


def class_table() -> np.ndarray:
    """Class of each code point in lower case text."""
    table = np.zeros(0x110000, np.uint8)
    for c, k in CLASS.items():
        table[ord(c)] = k
    other = [c for c in range(0x100, 0x30000) if chr(c).isalpha()]
    table[other] = OTHER
    return table


def trigram_counts(texts: DataFrame) -> np.ndarray:
    """Counts of class trigrams over whole texts; an edge comes before and after each."""
    def run(batches):
        table, total = class_table(), np.zeros(CLASSES ** 3, np.int64)
        for b in slices(batches):
            text = "  ".join(["", *b.column("text").to_pylist(), ""]).lower()
            k = table[np.frombuffer(text.encode("utf-32-le"), np.uint32)].astype(np.int32)
            total += np.bincount((k[:-2] * CLASSES + k[1:-1]) * CLASSES + k[2:], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["code", "n"])
    rows = texts.select("text").mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CLASSES ** 3)
    out[rows.column("code").to_numpy()] = rows.column("n").to_numpy()
    return out


def log_model(counts: np.ndarray) -> np.ndarray:
    """log p(c | a, b), trigram backed by bigram and unigram."""
    c3 = counts.reshape(CLASSES, CLASSES, CLASSES)
    c2, c1 = c3.sum(axis=0), c3.sum(axis=(0, 1))
    p1 = (c1 + 1) / (c1 + 1).sum()
    p2 = (c2 + 5 * p1) / (c2.sum(axis=1, keepdims=True) + 5)
    return np.log((c3 + 5 * p2[None]) / (c3.sum(axis=2, keepdims=True) + 5)).astype(np.float32)


@functools.lru_cache(4_000)
def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each run of equal characters what it may stand for, with the channel's cost."""
    out = []
    for run in re.finditer(r"(.)\1*", token, re.DOTALL):
        c, n = run[1], len(run[0])
        if c.isalpha():
            out.append([(c * n, 0.0)] if n < 3 else [(c, SHORTENED), (c * 2, SHORTENED)])
        else:
            each = [(x * k, SUBSTITUTED * k) for x in LEET.get(c, "") for k in ((1,) if n == 1 else (1, 2))]
            out.append([*each, ("", DROPPED if c not in LEET else SUBSTITUTED * 3)])
    return out


def advance(best: dict, options: list[tuple[str, float]], model: list) -> dict:
    """Best (score, path before, letters) of each pair of last classes, after one more place of a lattice."""
    after: dict[tuple[int, int], tuple] = {}
    for (a, b), path in best.items():
        for letters, cost in options:
            x, y, s = a, b, path[0] - cost
            for c in letters:
                k = CLASS.get(c, OTHER)
                s += model[x][y][k]
                x, y = y, k
            if (x, y) not in after or s > after[x, y][0]:
                after[x, y] = (s, path, letters)
    return after


def likely_spans(pieces: tuple[str, ...], model: list) -> list[tuple[int, int]]:
    """Each run of two or more pieces that is one word in a reading of the row not more than ``MARGIN`` below the best reading."""
    place = [lattice(x) for x in pieces]
    reach = [0.0]  # best reading of the pieces before each gap
    spans: dict[tuple[int, int], float] = {}
    open_: dict[int, dict] = {}
    for j, options in enumerate(place):
        open_[j] = {(0, 0): (0.0, None, "")}
        ends = {}
        for i in list(open_):
            cost = JOINED if i < j else 0.0
            for step in options:
                open_[i] = advance(open_[i], [(x, c + cost) for x, c in step], model)
                cost = 0.0
            ends[i] = reach[i] + max([v[0] + model[a][b][0] for (a, b), v in open_[i].items()])
        reach.append(max(ends.values()))
        for i, v in ends.items():
            spans[i, j + 1] = v - reach[i]
            if v < reach[-1] - BEAM or j - i + 2 > WORD:
                del open_[i]  # no longer word from there comes near the best reading
    rest = [-math.inf] * len(pieces) + [0.0]
    for (i, j), v in sorted(spans.items(), reverse=True):
        rest[i] = max(rest[i], v + rest[j])
    return [(i, j) for (i, j), v in spans.items() if j - i > 1 and reach[i] + v + rest[j] >= reach[-1] - MARGIN]


def restore(token: str, model: list) -> str:
    """The likeliest reading of one token."""
    best: dict[tuple[int, int], tuple] = {(0, 0): (0.0, None, "")}  # (score, path before, letters)
    for options in lattice(token):
        best = advance(best, options, model)
    (_, path), out = max(((p[0] + model[a][b][0], p) for (a, b), p in best.items()), key=lambda x: x[0]), []
    while path:
        out.append(path[2])
        path = path[1]
    return "".join(reversed(out))


def joined(pieces: tuple[str, ...], model: list, read) -> list[str]:
    """Words of a row of fragments that aren't written as such; ``read`` restores a token."""
    if not any(c.isalpha() for x in pieces for c in x):
        return []
    # a letter three times in a row is one piece, as within a word
    whole = tuple(x for c, same in itertools.groupby(pieces) for n in [len(list(same))] for x in ([c * n] if len(c) == 1 and n > 2 else [c] * n))
    out = dict.fromkeys(read("".join(whole[i:j])) for i, j in likely_spans(whole, model))
    # each row of single characters in it as one word, too
    for single, own in itertools.groupby(pieces, lambda x: len(x) == 1):
        token = "".join(own) if single else ""
        if len(token) > 2 and any(c.isalpha() for c in token):
            out[read(token)] = None
    return list(out)


class Reader:
    """Restored words of texts."""

    def __init__(self, model: np.ndarray):
        table = model.tolist()  # nested lists: faster for single values
        # the caches don't refer to the reader, so that it goes with its task
        self.restore = read = functools.lru_cache(50_000)(lambda t: restore(t, table))
        self.read_row = functools.lru_cache(10_000)(lambda pieces: joined(pieces, table, read))

    def words(self, texts: pa.Array):
        """(restored distinct words, word of each occurrence, bounds, letter by letter words as (row, word))."""
        words, at, bounds = word_table(pc.utf8_lower(texts))
        suspect = pc.match_substring_regex(words, SUSPECT).to_numpy(zero_copy_only=False)
        plain = words.to_pylist()
        for i in np.flatnonzero(suspect).tolist():
            core = plain[i].strip(EDGES)
            if core and not core.isalpha() and any(c.isalpha() for c in core):
                core = self.restore(core)
            plain[i] = core
        for i, w in enumerate(plain):
            if len(w) > 2 and REPEATED.search(w):
                plain[i] = self.restore(w)
        return plain, at, bounds, list(self.spelled(words, at, bounds))

    def spelled(self, words: pa.Array, at: np.ndarray, bounds: np.ndarray):
        """(row, word) of words written as rows of fragments."""
        if not len(at):
            return
        row = row_of(bounds)
        # a word as a piece of a spelled one: without edge punctuation; a sign by itself may stand for a letter
        pieces = pc.if_else(pc.equal(pc.utf8_length(words), 1), words, pc.utf8_trim(words, EDGES))
        size = pc.utf8_length(pieces).to_numpy(zero_copy_only=False)
        short = ((size > 0) & (size <= FRAGMENT))[at]
        pieces = pieces.to_pylist()
        new = np.concatenate([[True], (short[1:] != short[:-1]) | (row[1:] != row[:-1])])
        head = np.flatnonzero(new)
        end = np.concatenate([head[1:], [len(at)]])
        some = short[head] & (end - head > 2)
        for s, e in zip(head[some].tolist(), end[some].tolist(), strict=True):
            for x in self.read_row(tuple(pieces[w] for w in at[s:e].tolist())):
                yield int(row[s]), x


def word_features(word: str) -> list[str]:
    """The word and its first 4 and 5 letters."""
    return ["=" + word, *(word[:k] for k in (4, 5) if len(word) >= k)]


def evidence(weights: dict[str, float], texts: pa.Array, reader: Reader) -> np.ndarray:
    """(strongest weight, log(1 + number of different strong words)) of each text."""
    plain, at, bounds, spelled = reader.words(texts)
    get = weights.get
    w = np.array([max(get("=" + x, 0.0), get(x[:4], 0.0), get(x[:5], 0.0)) for x in plain], np.float64)
    out = np.zeros((len(texts), 2))
    hit = np.flatnonzero(w[at] > 0)
    row = row_of(bounds)[hit]
    np.maximum.at(out[:, 0], row, w[at[hit]])
    strong = hit[w[at[hit]] > STRONG]
    pair = np.unique(row_of(bounds)[strong] * max(1, len(plain)) + at[strong])
    count = np.bincount(pair // max(1, len(plain)), minlength=len(texts)).astype(np.float64)
    for i, x in spelled:
        v = max(get(f, 0.0) for f in word_features(x) or [""])
        out[i, 0] = max(out[i, 0], v)
        count[i] += v > STRONG
    out[:, 1] = np.log1p(count)
    return out


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Newton's method with a small penalty."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        beta += np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-1 * np.eye(len(beta)), x.T @ (y - p) - 1e-1 * beta)
    return beta


def learn(sample: DataFrame, model: np.ndarray) -> tuple[dict[str, float], np.ndarray | None, float]:
    """(feature weights, logistic coefficients, share of toxic) from labelled texts (text, toxic)."""
    n = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return {}, None, n1 / max(1, n1 + n0)
    spark = sample.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def contexts(batches):
        reader = Reader(shared.value)
        for b in slices(batches):
            plain, at, bounds, spelled = reader.words(b.column("text"))
            before = np.concatenate([[-1], at[:-1]])
            before[bounds[:-1][bounds[:-1] < len(at)]] = -1
            for w, v in np.unique(np.stack([at, before], axis=1), axis=0).tolist() if len(at) else []:
                for f in word_features(plain[w]):
                    rows.append((f, plain[v] if v >= 0 else ""))
            rows.extend((f, "") for _, x in spelled for f in word_features(x))
            f, c = zip(*set(rows), strict=True) if rows else ((), ())
            rows.clear()
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array(c, pa.string())], ["feature", "context"])
    rows: list = []
    # evidence is a feature of at least CONTEXTS places; the most frequent FEATURES of them
    wide = materialize(sample.filter("toxic = 1").select("text").mapInArrow(contexts, "feature string, context string").distinct()
                       .groupBy("feature").agg(F.count("*").alias("n")).filter(F.col("n") >= CONTEXTS), "contexts")
    places = {r[0]: r[1] for r in wide.orderBy(F.desc("n"), "feature").limit(FEATURES).collect()}
    known = spark.sparkContext.broadcast(set(places))

    def texts_with(batches):
        reader = Reader(shared.value)
        for b in slices(batches):
            plain, at, bounds, spelled = reader.words(b.column("text"))
            own = [[f for f in word_features(x) if f in known.value] for x in plain]
            toxic = b.column("toxic").to_pylist()
            letterwise: dict[int, set[str]] = {}
            for i, x in spelled:
                letterwise.setdefault(i, set()).update(f for f in word_features(x) if f in known.value)
            count: dict[str, list[int]] = {}
            for i in range(b.num_rows):
                found = {f for w in set(at[bounds[i]:bounds[i + 1]].tolist()) for f in own[w]}
                found |= letterwise.get(i, set())
                for f in found:
                    count.setdefault(f, [0, 0])[toxic[i]] += 1
            f = list(count)
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.string()), *(pa.array([count[x][k] for x in f], pa.int64()) for k in (0, 1))], ["feature", "n0", "n1"])
    seen = sample.select("text", "toxic").mapInArrow(texts_with, "feature string, n0 long, n1 long").groupBy("feature").agg(F.sum("n0"), F.sum("n1")).collect()
    odds = {f: math.log((min(b, places[f]) + 0.5) / (n1 + 1)) - math.log((a + 0.5) / (n0 + 1)) for f, a, b in seen}
    weights = {f: w for f, w in odds.items() if w > 0.5}
    found = with_evidence(sample.select("toxic", "text"), model, weights, {"toxic": "int"}).toArrow()
    x = np.column_stack([found.column("strongest").to_numpy(), found.column("many").to_numpy()])
    return weights, logistic(x, found.column("toxic").to_numpy().astype(np.float64)), n1 / (n1 + n0)


def with_evidence(texts: DataFrame, model: np.ndarray, weights: dict[str, float], kept: dict[str, str]) -> DataFrame:
    """The ``kept`` columns of ``texts`` (name and type) with strongest and many."""
    shared = texts.sparkSession.sparkContext.broadcast((model, weights))
    names = list(kept)

    def run(batches):
        model, weights = shared.value
        reader = Reader(model)
        for b in slices(batches):
            e = evidence(weights, b.column("text"), reader)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(e[:, 0]), pa.array(e[:, 1])], [*names, "strongest", "many"])
    return texts.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in kept.items()) + ", strongest double, many double")


def restored_text(docs: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and restored: its words after deobfuscation, joined by single spaces."""
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        reader = Reader(shared.value)
        for b in slices(batches):
            plain, at, bounds, _ = reader.words(b.column("text"))
            text = [" ".join(plain[w] for w in at[s:e].tolist()) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(text, pa.string())], ["id", "restored"])
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, restored string").withColumnRenamed("id", id_col)


def score(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", fit_rows: int = FIT_ROWS, carry: list[str] | None = None) -> DataFrame:
    """One row per document: id (or the columns to ``carry``), held_out, score, predicted; labels are learned where not ``held_out``."""
    carry = [id_col] if carry is None else carry
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), held_out.alias("held_out"),
                      *(F.col(c).alias(f"c{i}") for i, c in enumerate(carry)))
    train = src.filter("not held_out")
    model = log_model(trigram_counts(train))
    chosen = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).filter("toxic in (0, 1) and id is not null")
              .groupBy("id").agg(F.max("toxic").alias("toxic")))
    marked = chosen.withColumn(id_col, F.col("id")).filter(~held_out).select("id", "toxic").orderBy(F.xxhash64("id"), "id").limit(fit_rows)
    sample = materialize(train.select("id", "text").join(F.broadcast(marked), "id").select("text", "toxic"), "labelled")
    if sample.count() > fit_rows:  # ids that repeat: as many distinct texts
        keyed = sample.withColumn("key", F.xxhash64("text", "toxic"))
        lowest = keyed.select("key").distinct().orderBy("key").limit(fit_rows)
        sample = materialize(keyed.join(F.broadcast(lowest), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic")).drop("key"), "labelled")
    weights, beta, share = learn(sample, model)
    names = ["held_out", *(f"c{i}" for i in range(len(carry)))]
    found = with_evidence(src.select("text", *names), model, weights, {c: src.schema[c].dataType.simpleString() for c in names})
    z = F.lit(share) if beta is None else 1 / (1 + F.exp(-(beta[0] + beta[1] * F.col("strongest") + beta[2] * F.col("many"))))
    return found.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "held_out", z.alias("score"), (z >= 0.5).cast("int").alias("predicted"))
