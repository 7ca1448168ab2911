"""SentencePiece BPE encoding and decoding, by backtracking.

A piece model joins, again and again, the neighbouring pair of symbols whose union has the best score (leftmost
in ties). Its result is the only division into pieces in which each two neighbours are compatible: joining
the letters of both anew gives just these two. So a text can be read from left to right:

* an Aho-Corasick automaton over the pieces gives the longest piece at each place;
* a piece is taken if it is compatible with the one before it (found by joining both anew; remembered),
  else the next shorter piece that begins it is tried;
* if none is left, the place is marked in a bitfield of failed places, the last piece is taken back and
  a shorter one tried there. No place is tried again once it failed, so the work is linear.

A text is cut where no piece can reach across (before a word mark that follows another letter; between letters that
stand side by side in no piece), which changes nothing, and each distinct part of a slice is encoded once.

Defined results: a null text counts as empty and has the end id only. Letters without a piece become byte
pieces, or the unknown id where the model has none (one for neighbours). Decoding skips null and control ids and
gives the unknown id's sign for ids outside the vocabulary; byte pieces that are not UTF-8 become U+FFFD.
Models with a normaliser, user-defined or unused pieces are refused.
"""

from __future__ import annotations

import array
import functools
import hashlib
import operator
import struct

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import slices, two_columns

# Fixed values of the model format: the sign for a blank, the kinds of pieces, the fields read.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
PIECES, TRAINER, NORMALIZER = 1, 2, 3
UNKNOWN_SIGN_FIELD, CHARSMAP_FIELD, DUMMY_PREFIX_FIELD, EXTRA_SPACE_FIELD = 44, 2, 3, 4
UNKNOWN_SIGN = " ⁇ "
#: Remembered parts of words: two generations of so many, of so many letters at most; remembered pairs.
CACHED, CACHED_CHARS, CACHED_PAIRS = 500_000, 64, 500_000
#: Codes of pieces begin above the letters'; START stands before the first.
PIECE = 0x110000
START = (1 << 21) - 1


def fields(data: bytes):
    """(number, value) of the fields of a protocol-buffer message: bytes, or an integer."""
    i = 0

    def varint():
        nonlocal i
        value = shift = 0
        while True:
            b = data[i]
            i += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value
    while i < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value = varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            value = data[i:i + size]
            i += size
        yield tag >> 3, value


class Pieces:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            message = list(fields(f.read()))
        normalizer = {k: v for number, value in message if number == NORMALIZER for k, v in fields(value)}
        trainer = {k: v for number, value in message if number == TRAINER for k, v in fields(value)}
        if normalizer.get(CHARSMAP_FIELD) or normalizer.get(EXTRA_SPACE_FIELD, 1):
            raise ValueError(f"{path}: only models without a normaliser that keep all blanks are read")
        self.prefix = MARK if normalizer.get(DUMMY_PREFIX_FIELD, 1) else ""
        self.unknown_sign = trainer.get(UNKNOWN_SIGN_FIELD, UNKNOWN_SIGN.encode()).decode()
        self.strings, self.kinds, scores = [], [], []
        for number, value in message:
            if number == PIECES:
                piece = dict(fields(value))
                self.strings.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
        if {USER_DEFINED, UNUSED} & set(self.kinds):
            raise ValueError(f"{path}: user-defined and unused pieces are not read")
        self.id = {s: i for i, s in enumerate(self.strings) if self.kinds[i] == NORMAL}
        self.plain_pieces = {i: s for s, i in self.id.items()}
        self.score = {s: scores[i] for s, i in self.id.items()}
        self.unknown = self.kinds.index(UNKNOWN)
        self.end = self.strings.index("</s>")
        self.byte = {int(s[1:-1], 16): i for i, s in enumerate(self.strings) if self.kinds[i] == BYTE}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.cut_words = not any(MARK in s.lstrip(MARK) for s in self.id)
        self.apart = "\n" not in "".join(self.id)  # no piece reaches over a line's end
        self.reach = {s[i:i + 2] for s in self.id for i in range(len(s) - 1)}  # letters that stand side by side in a piece
        # codes: a letter's own number for a letter without a piece, PIECE + id for a piece
        self.automaton = ahocorasick.Automaton()
        self.text_of, self.size, self.shorter = {}, {}, {}
        for s, i in self.id.items():
            self.automaton.add_word(s, (PIECE + i, len(s)))
            self.text_of[PIECE + i], self.size[PIECE + i] = s, len(s)
            # the longest piece that begins this one, else its first letter
            ahead = next((PIECE + self.id[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in self.id), ord(s[0]))
            if len(s) > 1:
                self.shorter[PIECE + i] = ahead
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.young: dict[str, tuple[bytes, int, str]] = {}
        self.old = self.young

    def join(self, text: str) -> list[str]:
        """The letters of a short text, joined by score."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, a: int, b: int) -> bool:
        """Whether the codes are what their letters join to; ``a`` is START for a first piece."""
        parts = [self.text_of.get(x) or chr(x) for x in (a, b) if x != START]
        fit = self.join("".join(parts)) == parts
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        self.pairs[a << 21 | b] = fit
        return fit

    def divide(self, text: str) -> list[int]:
        """The codes of a text's pieces (a letter without a piece stands for itself)."""
        n, size, shorter, pairs = len(text), self.size.get, self.shorter.get, self.pairs
        longest = list(map(ord, text)) if n <= CACHED_CHARS else array.array("i", map(ord, text))  # code of the longest piece at each place
        for last, (code, letters) in self.automaton.iter(text):
            longest[last + 1 - letters] = code  # the one that ends last is the longest
        failed, any_failed = bytearray((n >> 3) + 1), False  # a bit for each place
        taken = [START]
        at, code = 0, longest[0]
        while at < n:
            end = at + size(code, 1)
            if not any_failed or not failed[end >> 3] >> (end & 7) & 1:
                fit = pairs.get(taken[-1] << 21 | code)
                if self.fits(taken[-1], code) if fit is None else fit:
                    taken.append(code)
                    at = end
                    if at < n:
                        code = longest[at]
                    continue
            code = shorter(code)
            while code is None:  # nothing fits here: go back to the piece before
                failed[at >> 3] |= 1 << (at & 7)
                any_failed = True
                code = taken.pop()
                at -= size(code, 1)
                code = shorter(code)
        return taken[1:]

    def encoded(self, text: str) -> tuple[bytes, int, str]:
        """Ids of a word in decimal, each with a blank after it, their number, and what they decode to (word marks left in)."""
        ids = self.ids(text)
        back = self.surface(ids)
        return b"%d " * len(ids) % tuple(ids), len(ids), text if back == text else back

    def ids(self, text: str) -> list[int]:
        """Ids of a normalised text."""
        taken = self.divide(text)
        if min(taken) >= PIECE:
            return [x - PIECE for x in taken]
        out: list[int] = []
        for x in taken:
            if x >= PIECE:
                out.append(x - PIECE)
            elif self.byte:
                out.extend(self.byte[b] for b in chr(x).encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def surface(self, ids: list[int | None]) -> str:
        """What ids stand for, word marks left in."""
        plain = [s for s in map(self.plain_pieces.get, ids) if s is not None]
        if len(plain) == len(ids):
            return "".join(plain)
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(decode_bytes(bytes(run)))
                run.clear()
            if i is None:
                continue
            known = 0 <= i < len(self.strings) and i != self.unknown
            out.append(self.unknown_sign if not known else "" if self.kinds[i] == CONTROL else self.strings[i])
        return "".join(out)

    def plain(self, surface: str) -> str:
        """A decoded text from what its ids stand for."""
        return (surface.removeprefix(MARK) if self.prefix else surface).replace(MARK, " ")

    def decode(self, ids: list[int | None]) -> str:
        return self.plain(self.surface(ids))

    def words(self, text: str) -> list[str]:
        """A text, normalised and cut where no piece reaches across."""
        if not text:
            return []
        text = self.prefix + text.replace(" ", MARK)
        return regex.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", text) if self.cut_words else [text]

    def look_up(self, word: str) -> tuple[bytes, int, str]:
        """``encoded`` of a word, in parts between which no piece can reach (the signs after a word)."""
        got = self.young.get(word)
        if got is not None:
            return got
        cuts = [i for i, x in enumerate(map(operator.add, word, word[1:]), 1) if x not in self.reach] if self.byte else []
        if not cuts:
            return self.part(word)
        ids, counts, back = zip(*(self.part(word[a:b]) for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)), strict=True)
        return b"".join(ids), sum(counts), "".join(back)

    def part(self, word: str) -> tuple[bytes, int, str]:
        """``encoded``, remembered."""
        got = self.young.get(word) or self.old.get(word) or self.encoded(word)
        if len(word) <= CACHED_CHARS:
            if len(self.young) >= CACHED:
                self.old, self.young = self.young, {}
            self.young[word] = got
        return got

    def encode_all(self, texts: pa.Array):
        """(ids in decimal, each with a blank after it; their number; decoded text) of each text."""
        odd = pc.match_substring_regex(texts, f"^$|  |{MARK}|^ | $" + ("|\n" if not self.apart else "| \n|\n |\n\n|^\n|\n$"))
        odd = odd.to_numpy(zero_copy_only=False) | (not self.cut_words or not self.prefix)
        plain = pc.if_else(pa.array(odd), "", texts)
        # a line's end is a word of its own; the word after it has no mark
        lists = pc.split_pattern(pc.replace_substring(plain, "\n", " \n "), " ")
        coded = lists.flatten().dictionary_encode()
        names, at, bounds = coded.dictionary.to_pylist(), coded.indices.to_numpy(), lists.offsets.to_numpy()
        end = names.index("\n") if "\n" in names else -1
        marked = np.ones(len(at), bool)
        marked[1:][at[:-1] == end] = False
        marked[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
        marked[at == end] = False
        key = at * 2 + marked
        ids, back, count = [b""] * (2 * len(names)), [""] * (2 * len(names)), np.zeros(2 * len(names), np.int64)
        for k in np.flatnonzero(np.bincount(key, minlength=2 * len(names))).tolist():
            ids[k], count[k], back[k] = self.look_up(MARK * (k & 1) + names[k >> 1])
        total = np.concatenate([[0], np.cumsum(count[key])])[bounds]
        total, key = np.diff(total).tolist(), key.tolist()
        for i, is_odd in enumerate(odd.tolist()):
            if is_odd:
                parts = [self.look_up(w) for w in self.words(texts[i].as_py())]
                yield b"".join(x[0] for x in parts), sum(x[1] for x in parts), self.plain("".join(x[2] for x in parts))
            else:
                run = key[bounds[i]:bounds[i + 1]]
                yield b"".join(map(ids.__getitem__, run)), total[i], self.plain("".join(map(back.__getitem__, run)))


def decode_bytes(run: bytes) -> str:
    """Bytes as UTF-8; every byte that is no part of a letter becomes U+FFFD."""
    out = []
    while run:
        try:
            out.append(run.decode())
            break
        except UnicodeDecodeError as e:
            out.append(run[:e.start].decode() + "�")
            run = run[e.start + 1:]
    return "".join(out)


@functools.lru_cache(2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ids (array of int), the end id last."""
    def run(batches):
        for b in slices(batches):
            model = pieces(path)
            ids = [[*map(int, row.split()), model.end] for row, _, _ in model.encode_all(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])
    src = two_columns(docs, id_col, text_col)
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row: id and text. Null ids give the empty text."""
    def run(batches):
        for b in batches:
            text = [pieces(path).decode([i for i in x or [] if i is not None]) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(text, pa.string())], ["id", "text"])
    src = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, text string").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens (the end id too), and SHA-256 of the decimal ids joined by blanks and of the decoded text; one pass, no shuffle."""
    def run(batches):
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in slices(batches):
            model = pieces(path)
            end = b"%d" % model.end
            rows = [(n + 1, sha(ids + end), sha(text.encode())) for ids, n, text in model.encode_all(b.column("text"))]
            n, a, d = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n, pa.int64()), pa.array(a), pa.array(d)], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
    src = two_columns(docs, id_col, text_col)
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
