"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes with counts from all training
texts. The code length of a byte starts at the longest context that the trie has; a
context that hasn't seen the byte escapes to the next shorter one (escape estimate: its
number of distinct next bytes), where the bytes that the longer context has seen are
excluded; below order 0 the bytes left are equally likely. Byte 255, never part of UTF-8,
begins and ends a text.

Contexts of every text are counted by Spark, and none is dropped. The trie stays dealt over
tasks: the nodes of order ``LOW`` and below are sent to all (at most 256^(``LOW`` + 1) by
the alphabet, whatever the corpus size), longer contexts lie with those that end in the
same ``LOW`` + 1 bytes, so that a task has all that its codes ask for. The code length of
each distinct code is worked out there once; the most frequent codes (``CODES`` at most)
are sent to the tasks that score texts, all others are joined. The base score needs every
token's count in the same way: frequent tokens (``HEAD`` at most) are sent, all others
joined. What is sent or joined changes no result.

A group of codes that end alike is bounded by the alphabet, whatever the corpus size: 256^(``ORDER`` - ``LOW``) codes of 24
bytes at most, and what UTF-8 text has of them in practice.

Defined results: a null text counts as empty and has its end alone; a null id counts as
the empty text for the fold; repeated rows count, and are scored, each by itself; ties in frequency
only change what is sent or joined; without training text every byte is equally likely.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import MIX, row_of, slices, sums, two_columns, whole_groups, word_table
from strata.session import materialize

ORDER = 5
LOW = 2  # highest order that every task receives
CODES = 3 << 20
FLUSH = 3 << 20  # distinct codes that a counting or scoring task holds
HEAD, HEAD_BYTES = 1 << 17, 32
SLICE = 2 << 20
EDGE = 255


def mask(n: int) -> np.uint64:
    return np.uint64((1 << 8 * n) - 1)


def byte_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(codes, bounds): for each byte of each text, and its end, the byte with the ORDER bytes before it."""
    # an edge byte (written as \\x01 here, which lower case leaves alone) can't be in Arrow text: lay texts out by hand
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    step = sizes + ORDER + 1
    begin = np.cumsum(step) - step
    data = np.full(int(step.sum()), EDGE, np.uint8)
    flat = np.frombuffer(b"".join(x.as_buffer() for x in pc.ascii_lower(texts)), np.uint8)
    inside = np.ones(len(data), bool)
    lead = (begin[:, None] + np.arange(ORDER)).reshape(-1)
    inside[lead] = False
    keep = inside.copy()
    keep[begin + step - 1] = False
    data[keep] = flat
    code = np.zeros(len(data), np.uint64)
    for i in range(ORDER + 1):
        code[i:] |= data[:len(data) - i].astype(np.uint64) << np.uint64(8 * i)
    return code[inside], np.concatenate([[0], np.cumsum(sizes + 1)])


def gram_counts(texts: DataFrame) -> DataFrame:
    """(code, n, every) of all contexts with their next byte, over whole texts (text, held_out): occurrences where not held out, and everywhere; summed in each task before the shuffle."""
    def run(batches):
        codes, counts = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)
        for b in slices(batches, most=SLICE):
            held = b.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            more, bounds = byte_grams(b.column("text"))
            # the lowest bit tells a training text
            more = np.sort((more << np.uint64(1)) | np.repeat(~held, np.diff(bounds)).astype(np.uint64))
            head = np.flatnonzero(np.concatenate([[True], more[1:] != more[:-1]]))
            n = np.diff(np.concatenate([head, [len(more)]]))
            learned = (more[head] & np.uint64(1)).astype(np.int64)
            both = np.concatenate([codes, more[head] >> np.uint64(1)])
            n = np.concatenate([counts, np.stack([n * learned, n], axis=1)])
            order = np.argsort(both, kind="stable")
            both, n = both[order], n[order]
            head = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
            codes, counts = both[head], np.add.reduceat(n, head)
            if len(codes) > FLUSH:
                yield batch(codes, counts)
                codes, counts = codes[:0], counts[:0]
        if len(codes):
            yield batch(codes, counts)
    batch = lambda c, n: pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)), pa.array(n[:, 0]), pa.array(n[:, 1])], ["code", "n", "every"])
    return (texts.select("text", F.coalesce("held_out", F.lit(True)).alias("held_out")).mapInArrow(run, "code long, n long, every long")
            .groupBy("code").agg(F.sum("n").alias("n"), F.sum("every").alias("every")))


def least_count(counts: DataFrame, most: int) -> int:
    """The least count c so that at most ``most`` rows have n >= c, on a scale of 16 steps for each doubling."""
    step = counts.groupBy(F.floor(F.log2("n") * 16).alias("step")).count().orderBy(F.desc("step")).collect()
    least, total = None, 0
    for s, n in step:
        total += n
        if total > most:
            break
        least = s
    # 1/32: halfway between steps, so that rounding can't matter
    return 2 ** 62 if least is None else math.ceil(2 ** ((least - 1 / 32) / 16))


class Trie:
    """For each order k: sorted grams (k context bytes and the next), counts; contexts with total, kinds, and the excluded total below."""

    def __init__(self, grams: list[tuple[np.ndarray, np.ndarray]], low: Trie | None = None):
        self.grams = grams = [*(low.grams if low else []), *grams]  # with ``low``: the orders above it
        self.contexts = list(low.contexts) if low else []
        for k, (g, c) in list(enumerate(grams))[len(self.contexts):]:
            context = g >> np.uint64(8)
            head = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(g) else np.zeros(0, np.int64)
            add = lambda v, head=head: np.add.reduceat(v, head) if len(head) else np.zeros(0)
            below = np.zeros(len(g))
            if k:
                low, n = grams[k - 1]
                below = n[np.searchsorted(low, g & mask(k))].astype(np.float64)
            self.contexts.append((context[head], add(c.astype(np.float64)), add(np.ones(len(g))), add(below)))

    def log_probability(self, code: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each code's last byte."""
        out, left = np.zeros(len(code)), np.ones(len(code), bool)
        gone, gone_kinds = np.zeros(len(code)), np.zeros(len(code))
        for k in range(len(self.grams) - 1, -1, -1):
            (grams, counts), (contexts, total, kinds, below) = self.grams[k], self.contexts[k]
            if not len(grams):
                continue
            gram = code & mask(k + 1)
            at, g = find(contexts, gram >> np.uint64(8)), find(grams, gram)
            known = left & (at >= 0)
            weight, new = total[at] - gone, kinds[at] - gone_kinds
            hit = known & (g >= 0)
            out[hit] += np.log(counts[g[hit]] / (weight + new)[hit])
            escape = known & (g < 0) & (new > 0)
            out[escape] += np.log((new / np.where(escape, weight + new, 1))[escape])
            gone, gone_kinds = np.where(known, below[at], gone), np.where(known, kinds[at], gone_kinds)
            left &= ~hit
        return out - np.where(left, np.log(np.maximum(256 - gone_kinds, 1)), 0)


def find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key, -1 where there is none."""
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


class Head:
    """Logarithms of the frequent codes by hash; a code whose slot another has is searched for."""

    BITS = 22

    def __init__(self, codes: np.ndarray, logs: np.ndarray):
        """``codes`` are sorted."""
        self.codes, self.logs = codes, logs
        self.place = np.zeros(1 << self.BITS, np.int32)
        self.place[self.slot(codes)] = np.arange(len(codes))

    def slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * MIX) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __call__(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(logarithms, whether known); 0 where it isn't."""
        if not len(self.codes):
            return np.zeros(len(codes)), np.zeros(len(codes), bool)
        at = self.place[self.slot(codes)]
        miss = np.flatnonzero(self.codes[at] != codes)
        some, back = np.unique(codes[miss], return_inverse=True)
        at[miss] = find(self.codes, some)[back]
        return np.where(at >= 0, self.logs[at], 0.0), at >= 0


def order_grams(codes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(grams, counts) of order ``k``."""
    g = codes & mask(k + 1)
    order = np.argsort(g, kind="stable")
    g = g[order]
    head = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
    return g[head], np.add.reduceat(counts[order], head) if len(head) else counts[:0]


def code_logs(counts: DataFrame) -> DataFrame:
    """(code, every, log): natural logarithm of the probability of each code's last byte after the bytes before it, from all nodes of the trie."""
    ends = F.col("code").bitwiseAND(F.lit((1 << 8 * (LOW + 1)) - 1))
    low = counts.filter("n > 0").groupBy(ends.alias("code")).agg(F.sum("n").alias("n")).toArrow()
    shared = counts.sparkSession.sparkContext.broadcast((low.column("code").to_numpy().view(np.uint64), low.column("n").to_numpy()))

    def run(batches):
        codes, n = shared.value
        low, held, size = Trie([order_grams(codes, n, k) for k in range(LOW + 1)]), [], 0
        for t in whole_groups(batches, "context"):
            held.append(t)
            size += t.num_rows
            if size > FLUSH // 4:
                yield logs(low, held)
                held, size = [], 0
        if held:
            yield logs(low, held)

    def logs(low: Trie, tables: list[pa.Table]) -> pa.RecordBatch:
        t = pa.concat_tables(tables).combine_chunks()
        code, n = t.column("code").to_numpy().view(np.uint64), t.column("n").to_numpy()
        seen = n > 0
        trie = Trie([order_grams(code[seen], n[seen], k) for k in range(LOW + 1, ORDER + 1)], low)
        return pa.RecordBatch.from_arrays([t.column("code").chunk(0), t.column("every").chunk(0), pa.array(trie.log_probability(code))], ["code", "every", "log"])

    # all contexts above LOW with the same last LOW + 1 bytes meet in one task
    context = F.shiftright("code", 8).bitwiseAND(F.lit((1 << 8 * (LOW + 1)) - 1)).alias("context")
    dealt = counts.select(context, "code", "n", "every").repartition("context").sortWithinPartitions("context")
    return materialize(dealt.mapInArrow(run, "code long, every long, log double"), "logs")


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, c): words in lower case over whole texts."""
    def run(batches):
        for b in slices(batches):
            words, at, _ = word_table(pc.ascii_lower(b.column("text")))
            yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(at, minlength=len(words)).astype(np.int64))], ["token", "c"])
    return materialize(texts.select("text").mapInArrow(run, "token string, c long").groupBy("token").agg(F.sum("c").alias("c")), "tokens")


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", codes: int = CODES) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score; learns where not ``held_out``."""
    spark = docs.sparkSession
    src = two_columns(docs, id_col, text_col, held_out.alias("held_out"))
    train = src.filter("not held_out")
    logs = code_logs(materialize(gram_counts(src), "grams"))
    often = least_count(logs.select(F.col("every").alias("n")), codes)
    top = logs.filter(F.col("every") >= often).select("code", "log").toArrow()
    place = np.argsort(top.column("code").to_numpy())
    arrays = top.column("code").to_numpy()[place].view(np.uint64), top.column("log").to_numpy()[place]
    tokens = token_counts(train)
    ends = train.count()  # each training text has one end
    words, distinct = tokens.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    total, kinds = words + ends, distinct + (ends > 0)
    short = tokens.filter(F.octet_length("token") <= HEAD_BYTES)
    frequent = least_count(short.select(F.col("c").alias("n")), HEAD)
    head = short.filter(F.col("c") >= frequent).toArrow()
    shared = spark.sparkContext.broadcast((arrays, dict(zip(head.column("token").to_pylist(), head.column("c").to_pylist(), strict=True))))

    def run(batches):
        frequent, known = Head(*shared.value[0]), shared.value[1]
        for b in slices(batches, most=SLICE):
            codes, bounds = byte_grams(b.column("text"))
            lp, there = frequent(codes)
            lp = sums(lp, bounds) / math.log(10)
            # the other codes of each text, with their counts
            some, back = np.unique(codes[~there], return_inverse=True)
            key, code_times = np.unique(row_of(bounds)[~there] * max(1, len(some)) + back, return_counts=True)
            code_row, code = np.divmod(key, max(1, len(some)))
            code_to = pa.array(np.searchsorted(code_row, np.arange(b.num_rows + 1)).astype(np.int32))
            words, at, edge = word_table(pc.ascii_lower(b.column("text")))
            c = np.array([known.get(w, 0) for w in words.to_pylist()], np.float64)
            here = c[at] > 0
            n, found = np.diff(edge), sums(here.astype(np.int64), edge)
            logs = sums(np.log10(c + 1)[at], edge)
            # the other words of each text, with their counts
            row = row_of(edge)[~here]
            key, times = np.unique(row * max(1, len(words)) + at[~here], return_counts=True)
            row, word = np.divmod(key, max(1, len(words)))
            to = pa.array(np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                b.column("id"), b.column("held_out"), pa.array(n + 1), pa.array(found), pa.array(logs), pa.array(lp),
                pa.ListArray.from_arrays(to, words.take(pa.array(word))), pa.ListArray.from_arrays(to, pa.array(times.astype(np.int32))),
                pa.ListArray.from_arrays(code_to, pa.array(some[code].view(np.int64))), pa.ListArray.from_arrays(code_to, pa.array(code_times.astype(np.int32)))], names)

    names = ["id", "held_out", "n_tokens", "found", "logs", "score", "others", "times", "codes", "code_times"]
    rows = materialize(src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, held_out boolean, n_tokens long, found long, logs double, score double, others array<string>, times array<int>, codes array<long>, code_times array<int>")
                       .withColumn("row", F.monotonically_increasing_id()), "scored")
    other = (rows.select("row", F.explode(F.arrays_zip("others", "times")).alias("o")).select("row", F.col("o.others").alias("token"), F.col("o.times").alias("times"))
             .join(tokens, "token").groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more_logs")))
    rest = (rows.select("row", F.explode(F.arrays_zip("codes", "code_times")).alias("o")).select("row", F.col("o.codes").alias("code"), F.col("o.code_times").alias("times"))
            .join(logs.filter(F.col("every") < often).select("code", "log"), "code").groupBy("row").agg(F.sum(F.col("times") * F.col("log")).alias("rest")))
    base = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) + math.log10(ends + 1) - F.col("n_tokens") * math.log10(total + kinds + 1)
    return rows.join(other, "row", "left").join(rest, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("found") + F.coalesce("more", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"),
        (F.col("score") + F.coalesce("rest", F.lit(0.0)) / math.log(10)).alias("score"))
