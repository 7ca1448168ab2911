"""Byte-level BPE encoding and decoding with a published vocabulary.

A text is cut into pretokens; the bytes of a pretoken form a doubly linked list
of symbols, and a priority queue of (merge rank, place) says which neighbours to
join next. An entry is stale, and skipped, once the pair at its place has another
rank. Decoding concatenates the vocabulary strings. Inside a task texts are split
and numbered by Arrow, so each distinct pretoken of a slice is merged once.

Defined results: a null text counts as empty and gives no ids; repeated rows are rows of their
own. Strings of special tokens inside a text become their ids, as the tokenizers library does by
default. Decoding skips null ids and ids outside the vocabulary.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import slices, two_columns

# Fixed value: the pretoken pattern of this family of vocabularies.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Texts with other white space than single spaces and single line ends are cut by the pattern as a whole.
ODD_SPACE = r"[\t\x0b\f\r\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]|  |\n\n| \n|\n |^[ \n]|[ \n]$"
#: Remembered pretokens: two generations of so many, of so many characters at most.
CACHED, CACHED_CHARS = 200_000, 64


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def both(pairs) -> tuple[bytes, bytes]:
    a, b = zip(*pairs, strict=True) if (pairs := list(pairs)) else ((), ())
    return b"".join(a), b"".join(b)


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        byte = {c: b for b, c in enumerate(letters)}
        vocab = spec["model"]["vocab"]
        self.first = [vocab[c] for c in letters]
        self.rank, self.joined = {}, []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocab[a] << 32 | vocab[b]] = rank
            self.joined.append(vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.strings: dict[int, bytes] = {i: bytes(byte[c] for c in s) for s, i in vocab.items() if all(c in byte for c in s)}
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        self.pattern = regex.compile(PRETOKEN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.young: dict[str, tuple[bytes, bytes]] = {}
        self.old = self.young

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pretoken."""
        ids = [self.first[b] for b in data]
        n, rank, queue = len(ids), self.rank.get, []
        for i in range(n - 1):
            if (r := rank(ids[i] << 32 | ids[i + 1])) is not None:
                queue.append(r << 32 | i)
        if not queue:
            return ids
        heapq.heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n))
        while queue:
            top = heapq.heappop(queue)
            r, i = top >> 32, top & 0xFFFFFFFF
            j = after[i]
            if j >= n or ids[i] < 0 or rank(ids[i] << 32 | ids[j]) != r:
                continue  # stale
            k, new = after[j], self.joined[r]
            ids[i], ids[j], after[i], before[k] = new, -1, k, i
            if k < n and (s := rank(new << 32 | ids[k])) is not None:
                heapq.heappush(queue, s << 32 | i)
            p = before[i]
            if p >= 0 and (s := rank(ids[p] << 32 | new)) is not None:
                heapq.heappush(queue, s << 32 | p)
        return [x for x in ids if x >= 0]

    def pretoken(self, word: str) -> tuple[bytes, bytes]:
        """Ids of one pretoken as little-endian 32-bit integers, and the bytes they decode to."""
        got = self.young.get(word) or self.old.get(word)
        if got is None:
            ids = self.merge(word.encode())
            got = struct.pack(f"<{len(ids)}I", *ids), b"".join([self.strings[i] for i in ids])
        if len(word) <= CACHED_CHARS:
            if len(self.young) >= CACHED:
                self.old, self.young = self.young, {}
            self.young[word] = got
        return got

    def piece(self, text: str) -> tuple[bytes, bytes]:
        """The same of a text without special tokens."""
        found = self.pattern.findall(text)
        if len(found) == 1:
            return self.pretoken(found[0])
        return both(map(self.pretoken, found))

    def encode(self, text: str) -> tuple[bytes, bytes]:
        """The same of any text."""
        if not self.cut:
            return self.piece(text)
        return both((struct.pack("<I", self.special[x]), x.encode()) if x in self.special else self.piece(x) for x in self.cut.split(text) if x)

    def decode(self, ids: list[int | None]) -> bytes:
        return b"".join([self.strings.get(i, b"") for i in ids])

    def encode_all(self, texts: pa.Array):
        """For each text its ids and the bytes they decode to."""
        odd = pc.match_substring_regex(texts, ODD_SPACE)
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        odd = odd.to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts)
        lists = pc.split_pattern(pc.replace_substring(plain, "\n", " \n "), " ")
        coded = lists.flatten().dictionary_encode()
        words, at, bounds = coded.dictionary.to_pylist(), coded.indices.to_numpy(), lists.offsets.to_numpy()
        # a word has the blank before it unless it starts a text or a line
        end = words.index("\n") if "\n" in words else -1
        blank = np.ones(len(at), bool)
        blank[bounds[:-1][bounds[:-1] < bounds[1:]]] = False
        blank[1:][at[:-1] == end] = False
        blank[at == end] = False
        key = at * 2 + blank
        ids: list[bytes] = [b""] * (2 * len(words))
        back: list[bytes] = [b""] * (2 * len(words))
        for k in np.flatnonzero(np.bincount(key, minlength=2 * len(words))).tolist():
            if words[k >> 1]:
                ids[k], back[k] = self.piece(" " + words[k >> 1] if k & 1 else words[k >> 1])
        key = key.tolist()
        for i, is_odd in enumerate(odd.tolist()):
            if is_odd:
                yield self.encode(texts[i].as_py())
            else:
                run = key[bounds[i]:bounds[i + 1]]
                yield b"".join(map(ids.__getitem__, run)), b"".join(map(back.__getitem__, run))


@functools.lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ids (array of int)."""
    def run(batches):
        for b in slices(batches):
            flat = [np.frombuffer(x, "<u4").astype(np.int32) for x, _ in codec(path).encode_all(b.column("text"))]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in flat])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.ListArray.from_arrays(offsets, np.concatenate(flat))], ["id", "ids"])
    src = two_columns(docs, id_col, text_col)
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row: id and text. Null ids give the empty text; bytes that are not UTF-8 become U+FFFD."""
    def run(batches):
        for b in batches:
            text = [codec(path).decode(x or []).decode("utf-8", "replace") for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(text, pa.string())], ["id", "text"])
    src = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, and SHA-256 of the ids (little-endian 32-bit) and of the decoded text; one pass, no shuffle."""
    def run(batches):
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in slices(batches):
            rows = [(len(ids) // 4, sha(ids), sha(text.decode("utf-8", "replace").encode())) for ids, text in codec(path).encode_all(b.column("text"))]
            n, a, d = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(a), pa.array(d)], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
    src = two_columns(docs, id_col, text_col)
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
