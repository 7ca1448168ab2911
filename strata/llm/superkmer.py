"""Repeated passages by super-k-mer partitioning.

A window is ``width`` consecutive words of a document. Its minimiser is the run of
``m`` words in it with the smallest hash (leftmost in ties), so equal windows have
equal minimisers. Consecutive windows with one minimiser occurrence travel as one
packed string to the minimiser's bucket; there all windows of the bucket are sorted,
and equal neighbours (compared word by word) are one window with its smallest id.

Spans of repeated windows go back to their text by its id and a 32-bit hash of it, and carry a 64-bit sum of their
words' hashes by place: where texts with one id (null, say) share the hash, only the text that has these words at that place,
for which the finding holds as well, loses them. Copies with one id have the same spans, which are one wherever they meet.

Before the shuffle equal packed strings of a slice collapse to their smallest id:
the others' windows are known to repeat at once and travel as plain spans, spread by
document. So a passage in a third of all documents sends one string a slice to its bucket.
Strings of a slice for one bucket travel as one compressed block.

Defined results: a null text has no words; a null id counts as larger than any other;
rows with equal ids never remove each other's words; texts with fewer than ``width``
words lose none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import MIX, grams, hashes, mix, row_of, slices, two_columns, whole_groups, word_table

SPAN = "id long, text_key int, start int, count int, check long"
NAMES = ["id", "text_key", "start", "count", "check"]
SPANS = pa.schema([("id", pa.int64()), ("text_key", pa.int32()), ("start", pa.int32()), ("count", pa.int32()), ("check", pa.int64())])
#: Buckets for each shuffle partition.
SPREAD = 8
#: Longer words (bytes) are hashed one by one; masks of the first 0 to 8 bytes.
LONG, FIRST = 64, np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
ZSTD = pa.Codec("zstd", compression_level=6)


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a time; long words by xxh3."""
    if not len(words):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.concatenate([np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]], np.zeros(8, np.uint8)])
    start, size = offsets[:-1] - offsets[0], np.diff(offsets)
    eight = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))
    out, rows = mix(size.astype(np.uint64) * MIX), np.arange(len(words))
    for at in range(0, LONG, 8):
        rows = rows[size[rows] > at]
        if not len(rows):
            return out
        out[rows] = mix(out[rows] * MIX + (eight[start[rows] + at] & FIRST[np.minimum(size[rows] - at, 8)]))
    rows = rows[size[rows] > LONG]
    out[rows] = hashes(words.take(pa.array(rows)))
    return out


def pack_block(ids: np.ndarray, keys: np.ndarray, starts: np.ndarray, strings: list[bytes]) -> bytes:
    raw = b"".join([np.diff(ids, prepend=0).tobytes(), keys.astype(np.int32).tobytes(), starts.astype(np.int32).tobytes(), b"\n".join(strings)])
    return np.array([len(ids), len(raw)], np.int64).tobytes() + ZSTD.compress(raw, asbytes=True)


def unpack_block(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    n, size = np.frombuffer(block[:16], np.int64).tolist()
    raw = ZSTD.decompress(block[16:], decompressed_size=size, asbytes=True)
    return (np.cumsum(np.frombuffer(raw[:8 * n], np.int64)), np.frombuffer(raw[8 * n:12 * n], np.int32),
            np.frombuffer(raw[12 * n:16 * n], np.int32), raw[16 * n:].decode().split("\n"))


def runs(doc: np.ndarray, at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Where a new run begins: another document, or ``at`` isn't where the row before ended (``after``)."""
    return np.flatnonzero(np.concatenate([[True], (at[1:] != after[:-1]) | (doc[1:] != doc[:-1])]))


class Places:
    """Sums of word hashes, each times its place in the span, for any span of a run of words."""

    def __init__(self, h: np.ndarray):
        zero = np.zeros(1, np.uint64)
        self.plain = np.concatenate([zero, np.cumsum(h)])
        self.placed = np.concatenate([zero, np.cumsum(h * np.arange(1, len(h) + 1, dtype=np.uint64))])

    def __call__(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        end = start + size
        return (self.placed[end] - self.placed[start]) - start.astype(np.uint64) * (self.plain[end] - self.plain[start])


def once(*columns: np.ndarray) -> np.ndarray:
    """The first row of each distinct combination of values."""
    order = np.lexsort(columns)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    return np.sort(order[new])


def span_batch(ids, keys, starts, counts, checks) -> pa.RecordBatch:
    """Spans, spread over the partitions by document."""
    columns = [pa.array(ids), pa.array(keys, pa.int32()), pa.array(starts.astype(np.int32)), pa.array(counts.astype(np.int32)), pa.array(checks.view(np.int64))]
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.nulls(len(ids), pa.binary()), *columns], ["bucket", "block", *NAMES])


def super_kmers(batch: pa.RecordBatch, width: int, m: int):
    """Packed strings of a slice, their buckets, documents (row), first windows, window counts, and the words' hashes and each text's first word."""
    words, at, bounds = word_table(batch.column("text"))
    if len(at) < width:
        return None
    h = word_hashes(words)[at]
    low = sliding_window_view(grams(h, m), width - m + 1).argmin(axis=1)
    start = np.arange(len(low))
    doc = row_of(bounds)[:len(low)]
    inside = start + width <= bounds[doc + 1]
    start, doc, place = start[inside], doc[inside], (start + low)[inside]
    if not len(start):
        return None
    head = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])]))
    count = np.diff(np.concatenate([head, [len(start)]]))
    first = start[head]
    flat = words.take(pa.array(at))
    blob = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), flat), " ")[0].as_buffer().to_pybytes()
    begin = np.concatenate([[0], np.cumsum(pc.binary_length(flat).to_numpy() + 1)])
    packed = [blob[a:b] for a, b in zip(begin[first].tolist(), (begin[first + count + width - 1] - 1).tolist(), strict=True)]
    return pa.array(packed, pa.binary()), grams(h, m)[place[head]].view(np.int64), doc[head], first - bounds[doc[head]], count, h, bounds


def emit(batch: pa.RecordBatch, width: int, m: int, buckets: int):
    """Blocks for the buckets, and spans of windows that a smaller id in this slice has too."""
    found = super_kmers(batch, width, m)
    if found is None:
        return
    packed, bucket, doc, first, count, h, bounds = found
    ids, keys = batch.column("id").to_numpy()[doc], batch.column("text_key").to_numpy()[doc]
    code = packed.dictionary_encode().indices.to_numpy()
    copies = len(np.unique(batch.column("id").to_numpy())) < batch.num_rows  # with one id, perhaps
    least = np.full(code.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, code, ids)
    late = np.flatnonzero(ids > least[code])
    if len(late):
        head = runs(doc[late], first[late], (first + count)[late])
        start, n = first[late][head], np.add.reduceat(count[late], head)
        spans = ids[late][head], keys[late][head], start, n, Places(h)(bounds[doc[late][head]] + start, n + width - 1)
        some = once(*spans) if copies else slice(None)
        yield span_batch(*(x[some] for x in spans))
    rest = np.flatnonzero(ids == least[code])
    if copies:
        rest = rest[once(first[rest], code[rest], keys[rest], ids[rest])]
    bucket = (bucket.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
    rest = rest[np.argsort(bucket[rest], kind="stable")]
    own = bucket[rest]
    edge = np.concatenate([np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])), [len(rest)]])
    strings = packed.take(pa.array(rest)).to_pylist()
    blocks = [pack_block(ids[rest[s:e]], keys[rest[s:e]], first[rest[s:e]], strings[s:e]) for s, e in zip(edge[:-1], edge[1:], strict=True)]
    none = [pa.nulls(len(blocks), t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64())]
    yield pa.RecordBatch.from_arrays([pa.array(own[edge[:-1]]), pa.array(blocks, pa.binary()), *none], ["bucket", "block", *NAMES])


def window_least(strings: pa.Array, ids: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """For each window of the packed strings: row, number in its row, the smallest id of an equal window, and its place; and the words' hashes."""
    words, at, bounds = word_table(strings)
    plain = word_hashes(words)[at]
    h = grams(plain, width)
    doc = row_of(bounds)[:len(h)]
    start = np.flatnonzero(np.arange(len(h)) + width <= bounds[doc + 1])
    doc, order = doc[start], np.argsort(h[start], kind="stable")
    same_hash = h[start][order][1:] == h[start][order][:-1]
    a, b = start[order][:-1], start[order][1:]
    same = same_hash.copy()
    for i in range(width):
        same &= at[a + i] == at[b + i]
    if (same != same_hash).any():  # different windows with one hash: number the windows themselves
        group = np.unique(sliding_window_view(at, width)[start], axis=0, return_inverse=True)[1].reshape(-1)
    else:
        group = np.empty(len(start), np.int64)
        group[order] = np.cumsum(np.concatenate([[True], ~same])) - 1
    least = np.full(group.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, ids[doc])
    return doc, start - bounds[doc], least[group], start, plain


def count_bucket(table: pa.Table, width: int):
    """Spans of the repeated windows of whole buckets."""
    plain = pc.is_null(table.column("block"))
    if pc.any(plain).as_py():
        # the same span from several slices is one
        yield from table.filter(plain).select(NAMES).group_by(NAMES).aggregate([]).select(NAMES).cast(SPANS).to_batches()
    bucket, blocks = table.column("bucket").to_numpy(), table.column("block").to_pylist()
    for one in np.unique(bucket):
        mine = [unpack_block(blocks[i]) for i in np.flatnonzero(bucket == one) if blocks[i] is not None]
        if not mine:
            continue
        ids, keys, starts = (np.concatenate([x[i] for x in mine]) for i in range(3))
        doc, number, least, place, h = window_least(pa.array([x for m in mine for x in m[3]]), ids, width)
        hit = least < ids[doc]
        if hit.any():
            doc, at, place = doc[hit], (number + starts[doc])[hit], place[hit]
            head = runs(doc, at, at + 1)
            doc, at, n, place = doc[head], at[head], np.diff(np.concatenate([head, [len(doc)]])), place[head]
            spans = ids[doc], keys[doc], at, n, Places(h)(place, n + width - 1)
            some = once(*spans)
            yield span_batch(*(x[some] for x in spans)).select(NAMES)


def keyed(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    src = two_columns(docs, id_col, text_col, *more)
    return src.withColumn("key", F.coalesce(F.col("id").cast("long"), F.lit(2 ** 63 - 1))).withColumn("text_key", F.hash("text"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13, m: int = 3) -> DataFrame:
    """(id, text_key, start, count, check): windows start .. start + count - 1 of that text also start in a document with a smaller id."""
    def deal(batches):
        for b in slices(batches):
            yield from emit(b, width, m, buckets)

    def count(batches):
        for t in whole_groups(batches, "bucket"):
            yield from count_bucket(t, width)

    buckets = SPREAD * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = keyed(docs, id_col, text_col).select(F.col("key").alias("id"), "text_key", "text")
    rows = src.mapInArrow(deal, "bucket long, block binary, " + SPAN)
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(count, SPAN)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13, m: int = 3,
                   carry: list[str] | None = None) -> DataFrame:
    """One row per document: id (or the columns to ``carry``), n_words, n_removed, kept_sha256, and kept: the text that is left
    (kept words joined by single spaces; the text as it was, or null, where nothing is removed)."""
    carry = [id_col] if carry is None else carry
    spans = repeated_spans(docs, id_col, text_col, width, m)
    per_doc = spans.groupBy(F.col("id").alias("key"), "text_key").agg(*(F.collect_list(c).alias(f"{c}s") for c in ("start", "count", "check")))
    names = [f"c{i}" for i in range(len(carry))]
    src = keyed(docs, id_col, text_col, F.col(text_col).alias("given"), *(F.col(c).alias(n) for c, n in zip(carry, names, strict=True)))
    joined = src.select("given", "key", "text_key", *names).join(per_doc, ["key", "text_key"], "left").select("given", "starts", "counts", "checks", *names)

    def run(batches):
        for b in slices(batches, "given"):
            words, at, bounds = word_table(pc.fill_null(b.column("given"), ""))
            flat = words.take(pa.array(at))
            removed = np.zeros(len(at), bool)
            any_found = b.column("starts").null_count < b.num_rows
            places = Places(word_hashes(words)[at]) if any_found else None
            for i, found in enumerate(zip(b.column("starts"), b.column("counts"), b.column("checks"), strict=True)):
                if found[0].is_valid:
                    step = np.zeros(bounds[i + 1] - bounds[i] + 1, np.int64)
                    s, c, check = (x.values.to_numpy() for x in found)
                    inside = s + c + width - 1 <= bounds[i + 1] - bounds[i]
                    s, c, check = s[inside], c[inside], check[inside]
                    own = places(bounds[i] + s, c + width - 1) == check.view(np.uint64)
                    s, c = s[own], c[own]
                    np.add.at(step, s, 1)
                    np.add.at(step, s + c + width - 1, -1)
                    removed[bounds[i]:bounds[i + 1]] = np.cumsum(step[:-1]) > 0
            left = np.concatenate([[0], np.cumsum(~removed)])[bounds]
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), flat.filter(pa.array(~removed))), " ")
            n, k = np.diff(bounds), np.diff(left)
            sha = [hashlib.sha256(x.as_buffer()).hexdigest() for x in text]
            kept = pc.if_else(pa.array(n == k), b.column("given"), text)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(n), pa.array(n - k), pa.array(sha), kept], [*names, "n_words", "n_removed", "kept_sha256", "kept"])

    kinds = "".join(f"{c} {src.schema[c].dataType.simpleString()}, " for c in names)
    out = joined.mapInArrow(run, kinds + "n_words long, n_removed long, kept_sha256 string, kept string")
    return out.select(*(F.col(n).alias(c) for c, n in zip(carry, names, strict=True)), "n_words", "n_removed", "kept_sha256", "kept")
