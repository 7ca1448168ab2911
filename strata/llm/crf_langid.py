"""Language of texts by a linear-chain conditional random field over their words.

Each word is a place in the chain and each learned language a label; a word of more than
``LETTERS`` characters, or of several scripts, is cut at punctuation and script changes into
places of ``LETTERS`` at most, so that every letter counts (text without white space, too). A word's emission
score sums weights of hashed features: its first and last 1 to 4 letters, its letter
2- and 3-grams, the word itself, and its log share of each language in a lexicon; learned
transition weights tie neighbouring words. Forward-backward gives each word's label
probabilities, so code-switched text gets a label for each word; a text's language is the
one with the largest expected number of words, its score that share.

The lexicon counts the words of all training texts (hashed to ``LEXICON`` cells, summed
by Spark). Weights are fitted by stochastic gradient ascent on the chains of a bounded
sample of ``FIT_ROWS`` labelled texts of ``FIT_BYTES`` together (the lowest hashes of id and text, as many of each
language; documented limits, but one text of each language at least; whole texts, equal rows once). Every language is learned:
lexicon and weights hold only the cells seen. A chain is at most ``CHAIN`` words long; longer texts are a row of chains.

Defined results: ``und`` with score 0 for a text that is null or has no letter, and for
every text if nothing was learned; null languages aren't learned. Languages that tie: the first by name.
Repeated rows count each in the lexicon, once in the sample, and are predicted alike.
"""

from __future__ import annotations

import functools
import itertools
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import MIX, hashes, mix, slices, sums, word_table

FIT_ROWS = 1000
FIT_BYTES = 64 << 20
LEXICON = 1 << 16
HASHED = 1 << 18
CHAIN = 64
LETTERS = 16  # letters of a place
SIGNS = ".,;:!?\"'()[]{}|*%&$#-"


@functools.lru_cache(1 << 16)
def script(c: str) -> str | None:
    """First part of a letter's Unicode name; empty for digits and marks, which go with the letters before them; None for punctuation and signs."""
    kind = unicodedata.category(c)
    if c.isalpha() and kind != "Lm":
        return unicodedata.name(c, "OTHER").split(" ")[0].split("-")[0]
    return None if kind[0] in "PSZC" and c not in "'’\u200c\u200d" else ""


def pieces(word: str) -> list[str]:
    """The places of a word."""
    # an ASCII word in edge punctuation is one place, as is any short word of one script
    if len(word.strip(SIGNS)) <= LETTERS and (word.isascii() or len({script(c) for c in word} - {"", None}) < 2):
        return [word]
    out, last = [""], ""
    for c in word:
        own = script(c)
        if own is None or (own and last and own != last):
            out.append("")
            last = ""
        if own is not None:
            out[-1] += c
            last = own or last
    return [x[i:i + LETTERS] for x in out for i in range(0, len(x), LETTERS)] or [word]


def place_table(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``word_table`` of the places of each text."""
    words, at, bounds = word_table(texts)
    cut = [pieces(w) for w in words.to_pylist()]
    n = np.array([len(x) for x in cut], np.int64)
    coded = pa.array(list(itertools.chain.from_iterable(cut)), pa.string()).dictionary_encode()
    first, each = np.cumsum(n) - n, n[at]
    ends = np.cumsum(each)
    nth = np.arange(each.sum()) - np.repeat(ends - each, each)
    return coded.dictionary, coded.indices.to_numpy()[np.repeat(first[at], each) + nth], np.concatenate([[0], ends])[bounds]


def letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points from the start, code points from the end, length) of each word in lower case without edge punctuation."""
    w = pc.utf8_lower(words).to_pylist()
    w = [x.strip(SIGNS) for x in w]
    n = np.array([len(x) for x in w])
    left = np.array([x[:LETTERS] for x in w], f"U{LETTERS}") if w else np.zeros(0, f"U{LETTERS}")
    right = np.array([x[:-LETTERS - 1:-1] for x in w], f"U{LETTERS}") if w else left
    view = lambda a: a.view(np.uint32).reshape(len(w), LETTERS)
    return view(left), view(right), np.minimum(n, LETTERS)


def features(words: pa.Array, word_hash: np.ndarray):
    """Yield (rows, hashed feature) arrays, one for each kind of feature."""
    left, right, n = letters(words)
    every = np.arange(len(n))
    for salt, side in ((1, left), (2, right)):
        h = np.full(len(n), salt, np.uint64)
        for k in range(4):
            h = mix(h * MIX + side[:, k])
            rows = every[n > k]
            yield rows, (h[rows] + np.uint64(k)) % np.uint64(HASHED)
    for size in (2, 3):
        for at in range(LETTERS - size + 1):
            rows = every[n >= at + size]
            if not len(rows):
                break
            h = np.full(len(rows), 10 + size, np.uint64)
            for k in range(size):
                h = mix(h * MIX + left[rows, at + k])
            yield rows, h % np.uint64(HASHED)
    yield every, mix(word_hash) % np.uint64(HASHED)


def totals(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Column sums of ``values`` for each of ``n`` groups."""
    return np.stack([np.bincount(group, values[:, k], minlength=n) for k in range(values.shape[1])], axis=1)


class Model:
    def __init__(self, labels: list[str], lexicon: np.ndarray | tuple[np.ndarray, np.ndarray, np.ndarray]):
        """``lexicon``: counts by cell and label, or (cells, labels, counts) of those seen."""
        self.labels = labels
        n = len(labels)
        cell, label, count = lexicon if isinstance(lexicon, tuple) else (*np.nonzero(lexicon), lexicon[np.nonzero(lexicon)])
        order = np.argsort(cell, kind="stable")
        self.first = np.searchsorted(cell[order], np.arange(LEXICON + 1))
        # log share of a label in its cell, less that of a label not seen there: what all labels have alike cancels
        self.label, self.share = label[order], np.log((count[order] + 0.5) / 0.5).astype(np.float32)
        self.row = np.zeros(HASHED, np.int32)  # row of weights of a feature; 0 if it wasn't seen in learning
        self.weights = np.zeros((1, n), np.float32)
        self.trust = np.float32(0.5)  # weight of the lexicon
        self.moves = (np.eye(n) * 2).astype(np.float32)

    def emissions(self, words: pa.Array) -> np.ndarray:
        h = hashes(words)
        out = np.zeros((len(words), len(self.labels)), np.float32)
        cell = (h % np.uint64(LEXICON)).astype(np.int64)
        n = self.first[cell + 1] - self.first[cell]
        entry = np.arange(n.sum()) + np.repeat(self.first[cell] - (np.cumsum(n) - n), n)
        out[np.repeat(np.arange(len(words)), n), self.label[entry]] += self.trust * self.share[entry]
        for rows, f in features(words, h):
            out[rows] += self.weights[self.row[f.astype(np.int64)]]  # a row comes once in each kind
        return out

    def chains(self, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chains of consecutive words: (first occurrence, length)."""
        each = -(-n_words // CHAIN)
        begin = np.repeat(np.cumsum(n_words) - n_words, each)
        nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        first = begin + nth * CHAIN
        return first, np.minimum(CHAIN, np.repeat(n_words, each) - nth * CHAIN)

    def marginals(self, score: np.ndarray, n_words: np.ndarray, pairs: bool = False):
        """Label probabilities of each word; with ``pairs`` also the expected number of each transition."""
        first, length = self.chains(n_words)
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        alive = np.searchsorted(-length, -np.arange(1, CHAIN + 1), side="right")  # chains that reach step t
        move = np.exp(self.moves.astype(np.float64))
        local = np.exp(np.clip(score - score.max(axis=1, keepdims=True), -40, 0)).astype(np.float64)
        n = len(self.labels)
        forward = np.empty((len(score), n))
        f = np.full((len(first), n), 1.0 / n)
        for t in range(CHAIN):
            k = alive[t]
            if not k:
                break
            f = local[first[:k] + t] * (f[:k] @ move if t else f[:k])
            f /= f.sum(axis=1, keepdims=True)
            forward[first[:k] + t] = f
        out, total = np.empty_like(forward), np.zeros((n, n))
        back = np.ones((len(first), n))
        for t in range(CHAIN - 1, -1, -1):
            k = alive[t]
            if not k:
                continue
            p = forward[first[:k] + t] * back[:k]
            out[first[:k] + t] = p / p.sum(axis=1, keepdims=True)
            if t:
                right = local[first[:k] + t] * back[:k]
                if pairs:
                    before = forward[first[:k] + t - 1]
                    total += move * ((before / ((before @ move) * right).sum(axis=1, keepdims=True)).T @ right)
                right = right @ move.T
                back[:k] = right / right.sum(axis=1, keepdims=True)
        return (out, total) if pairs else out

    def fit(self, texts: pa.Array, label: np.ndarray, rounds: int = 3, rate: float = 0.2, batch: int = 100) -> None:
        """Adagrad on the log likelihood of the label sequences; each word of a text has the text's label."""
        words = place_table(texts)[0]
        seen = np.zeros(HASHED, bool)
        for _, f in features(words, hashes(words)):
            seen[f.astype(np.int64)] = True
        self.row[seen] = np.arange(1, seen.sum() + 1)
        self.weights = np.zeros((int(seen.sum()) + 1, len(self.labels)), np.float32)
        scale = np.full(self.weights.shape, 1e-3, np.float32)
        move_scale = np.full(self.moves.shape, 1e-3, np.float32)
        rng = np.random.default_rng(0)
        n = len(self.labels)
        for _ in range(rounds):
            order = rng.permutation(len(texts))
            for s in range(0, len(order), batch):
                part = order[s:s + batch]
                words, at, bounds = place_table(texts.take(pa.array(part)))
                if not len(at):
                    continue
                per = np.diff(bounds)
                truth = np.repeat(label[part], per)
                p, moved = self.marginals(self.emissions(words)[at], per, pairs=True)
                error = -p
                error[np.arange(len(at)), truth] += 1
                # texts count alike, whatever their length
                error *= np.repeat(1 / np.maximum(per, 1), per)[:, None]
                by_word = totals(at, error, len(words))
                for rows, f in features(words, hashes(words)):
                    some, back = np.unique(self.row[f.astype(np.int64)], return_inverse=True)
                    step = totals(back, by_word[rows], len(some)).astype(np.float32)
                    scale[some] += step ** 2
                    self.weights[some] += rate * step / np.sqrt(scale[some])
                steps = np.maximum(per - 1, 0)
                seen = np.zeros((n, n))
                np.add.at(seen, (label[part], label[part]), steps)
                step = ((seen - moved) / max(1, steps.sum())).astype(np.float32)
                move_scale += step ** 2
                self.moves += rate * 0.2 * step / np.sqrt(move_scale)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        words, at, bounds = place_table(texts)
        lettered = pc.match_substring_regex(words, r"\p{L}").to_numpy(zero_copy_only=False)
        share = np.zeros((len(texts), len(self.labels)))
        if len(at):
            p = self.marginals(self.emissions(words)[at], np.diff(bounds)) * lettered[at][:, None]
            share = np.stack([sums(p[:, k], bounds) for k in range(len(self.labels))], axis=1)
        total = share.sum(axis=1)
        best = share.argmax(axis=1)
        known = sums(lettered[at].astype(np.int64), bounds) > 0
        score = np.where(known, share.max(axis=1) / np.maximum(total, 1e-12), 0.0)
        return [self.labels[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)], np.clip(score, 0, 1)


def lexicon(train: DataFrame) -> tuple[list[str], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(languages, (cells, languages, counts)): the words of each language by lexicon cell, over all training texts."""
    def run(batches):
        for b in slices(batches):
            words, at, bounds = place_table(b.column("text"))
            cell = (hashes(words) % np.uint64(LEXICON)).astype(np.int64)[at]
            lang = b.column("lang").dictionary_encode()
            own = np.repeat(lang.indices.to_numpy().astype(np.int64), np.diff(bounds))
            key, n = np.unique(own * LEXICON + cell, return_counts=True)
            yield pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(key // LEXICON)), pa.array((key % LEXICON).astype(np.int32)), pa.array(n)], ["lang", "cell", "n"])
    got = train.mapInArrow(run, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    labels = sorted(r[0] for r in train.select("lang").distinct().collect())
    return labels, (got.column("cell").to_numpy(), pc.index_in(got.column("lang"), pa.array(labels, pa.string())).to_numpy(), got.column("n").to_numpy().astype(np.float64))


def train_model(train: DataFrame, fit_rows: int) -> Model | None:
    """``train``: id, text, lang (not null)."""
    labels, counts = lexicon(train)
    if not labels:
        return None
    model = Model(labels, counts)
    # as many texts of each language, chosen without moving texts; equal rows are one
    train = train.withColumn("key", F.xxhash64("id", "text"))
    own = Window.partitionBy("lang")
    keys = train.select("lang", "key", F.octet_length("text").cast("long").alias("size")).distinct()
    keys = keys.withColumn("place", F.row_number().over(own.orderBy("key"))).filter(F.col("place") <= -(-fit_rows // len(labels)))
    keys = keys.withColumn("bytes", F.sum("size").over(own.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)))
    keys = keys.filter((F.col("place") == 1) | (F.col("bytes") <= FIT_BYTES // len(labels))).select("lang", "key")
    chosen = train.join(F.broadcast(keys), ["lang", "key"], "left_semi").groupBy("lang", "key").agg(F.first("text").alias("text"))
    sample = chosen.toArrow().sort_by([("key", "ascending"), ("lang", "ascending")])
    place = {x: i for i, x in enumerate(labels)}
    model.fit(sample.column("text").combine_chunks(), np.array([place[x] for x in sample.column("lang").to_pylist()]))
    return model


def predict_language(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per document: id, held_out, lang_pred, score; learns from text and language where not ``held_out``."""
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), held_out.alias("held_out"), F.col(lang_col).alias("lang"))
    model = train_model(src.filter("not held_out and lang is not null").select("id", "text", "lang"), fit_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in slices(batches):
            lang, score = shared.value.predict(b.column("text")) if shared.value else (["und"] * b.num_rows, np.zeros(b.num_rows))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("held_out"), pa.array(lang), pa.array(score)], ["id", "held_out", "lang_pred", "score"])

    kind = src.schema["id"].dataType.simpleString()
    return src.select("id", "held_out", "text").mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_col)
