"""Byte-level BPE encoding and decoding with an existing vocabulary.

Method: contiguous rank array. A pretoken ("word") is a row of part ids with the
merge rank of every adjacent pair beside it; the smallest rank is found by a
scan, its boundary is deleted, and the ranks of the two neighbouring pairs are
looked up again, until no pair has a rank. Words of one length are the rows of
one matrix, so each scan-merge-refresh step runs for all of them at once; only
words above ``SHORT`` bytes use a heap over a linked list (same result, no
quadratic scan).

Everything is row-local: one ``mapInArrow`` pass, no shuffle. The vocabulary
(50 thousand merges) is read once on the driver and broadcast: its size is that
of the tokenizer file, whatever the data.

Defined results: null text encodes like the empty text (no ids); repeated rows
are encoded alike; an empty table gives an empty table; input columns named like
the output columns are replaced, all others are kept.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chainmetrics.llm import textbuf as tb

SHORT = 32
#: Bytes of text encoded at once: repeated words within a slice are merged once.
SLICE = 512 << 10
NO_RANK = np.int32(2**31 - 1)
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: The contraction endings of the byte-level split pattern (fixed values).
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in of every byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the others for code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Token bytes, byte ids and the pair -> (rank, merged id) table of a tokenizer file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("a byte-level BPE tokenizer file is needed")
        alphabet, vocab = byte_alphabet(), model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        token_bytes = {i: bytes(alphabet[c] for c in t) for t, i in vocab.items() if i not in set(self.special.values())}
        token_bytes |= {i: t.encode() for t, i in self.special.items()}
        size = max(token_bytes) + 1
        parts = [token_bytes.get(i, b"") for i in range(size)]
        self.token_lens = np.array([len(p) for p in parts], np.int64)
        self.token_starts = np.concatenate(([0], np.cumsum(self.token_lens)[:-1]))
        self.token_data = np.frombuffer(b"".join(parts), np.uint8)
        self.byte_ids = np.zeros(256, np.int32)
        for c, b in alphabet.items():
            self.byte_ids[b] = vocab[c]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.uint64)
        right = np.array([vocab[b] for _, b in pairs], np.uint64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.pairs, self.merged = tb.HashTable(left << np.uint64(32) | right), merged

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, NO_RANK where the pair doesn't merge."""
        got = self.pairs.find(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64))
        return np.where(got < 0, NO_RANK, got)

    # -- merging ---------------------------------------------------------
    def merge_rows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank-array merge of equally long words (rows of byte ids) -> (ids, part counts)."""
        n, size = ids.shape
        out, counts = ids.copy(), np.full(n, size)
        if size == 1:
            return out, counts
        rows = np.arange(n)
        ranks = self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, size - 1)
        while True:
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            live = best != NO_RANK
            if not live.all():
                done = ~live
                out[rows[done], :ids.shape[1]] = ids[done]
                rows, ids, ranks, at, best = rows[live], ids[live], ranks[live], at[live], best[live]
            if not len(rows):
                return out, counts
            width = ids.shape[1]
            r = np.arange(len(rows))
            # Delete the boundary: parts behind it move one place to the left.
            later = np.arange(width - 1) > at[:, None]
            ids = np.where(later, ids[:, 1:], ids[:, :-1])
            ids[r, at] = self.merged[best]
            counts[rows] -= 1
            if width == 2:
                ranks = np.full((len(rows), 1), NO_RANK)
                ids = np.concatenate((ids, ids), 1)
                continue
            ranks = np.where(later[:, :-1], ranks[:, 1:], ranks[:, :-1])
            if width > 2:
                a = np.flatnonzero(at > 0)
                ranks[a, at[a] - 1] = self.rank(ids[a, at[a] - 1], ids[a, at[a]])
                b = np.flatnonzero(at < width - 2)
                ranks[b, at[b]] = self.rank(ids[b, at[b]], ids[b, at[b] + 1])

    def merge_long(self, word: np.ndarray) -> list[int]:
        """The same merges for one long word, by a heap over a linked list."""
        ids = self.byte_ids[word].tolist()
        n = len(ids)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        table, merged = self.lookup(), self.merged
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := table.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(merged[r]), -1
            nxt[i] = k = nxt[j]
            if k < n:
                prv[k] = i
                if (r := table.get((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[k]))
            if (h := prv[i]) >= 0 and (r := table.get((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (r, h, ids[h], ids[i]))
        return [x for x in ids if x >= 0]

    def lookup(self) -> dict:
        if not hasattr(self, "_table"):
            keys = self.pairs.keys[:-1]
            self._table = dict(zip(zip((keys >> np.uint64(32)).tolist(), (keys & np.uint64(2**32 - 1)).tolist()), range(len(keys))))
        return self._table

    # -- texts -----------------------------------------------------------
    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a slice, flat, with one offset per row."""
        starts, ends, special = pretokens(buf, offs, self.special)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
        keys = tb.span_hashes(buf, starts, ends)
        _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        lens = (ends - starts)[first]
        counts = np.zeros(len(first), np.int64)
        pieces: list[tuple[np.ndarray, np.ndarray]] = []  # (unique words, their ids one after the other)
        known = special[first]
        for size in np.unique(lens[known < 0]):
            who = np.flatnonzero((lens == size) & (known < 0))
            if size <= SHORT:
                raw = buf[starts[first[who]][:, None] + np.arange(size)]
                ids, counts[who] = self.merge_rows(self.byte_ids[raw])
                pieces.append((who, ids[np.arange(size) < counts[who][:, None]]))
            else:
                for w in who:
                    ids = np.array(self.merge_long(buf[starts[first[w]]:ends[first[w]]]), np.int32)
                    counts[w] = len(ids)
                    pieces.append((np.array([w]), ids))
        who = np.flatnonzero(known >= 0)
        counts[who] = 1
        pieces.append((who, known[who]))
        order = np.concatenate([w for w, _ in pieces])
        flat = np.concatenate([x for _, x in pieces])
        begin = np.zeros(len(first), np.int64)
        begin[order] = np.cumsum(counts[order]) - counts[order]
        n = counts[inverse]
        ids = flat[tb.ragged(begin[inverse], n)]
        total = np.concatenate(([0], np.cumsum(n)))
        return ids, total[np.searchsorted(starts, offs)]

    def decode(self, ids: np.ndarray, offs: np.ndarray) -> list[str]:
        """Texts of the id rows; invalid UTF-8 becomes U+FFFD."""
        n = self.token_lens[ids]
        data = self.token_data[tb.ragged(self.token_starts[ids], n)].tobytes()
        ends = np.concatenate(([0], np.cumsum(n)))[offs].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


#: Letters and numbers of Unicode 16, which the tokenizer library follows,
#: that version 15.1 of the interpreter's tables lacks.
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)


@lru_cache(1)
def _char_class() -> np.ndarray:
    """Class of every code point, from the Unicode categories."""
    spaces = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, *range(0x2000, 0x200B)]
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    for kind, ranges in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS)):
        for a, b in ranges:
            out[a:b + 1] = kind
    out[spaces] = SPACE
    return out


def pretokens(buf: np.ndarray, offs: np.ndarray, special: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of the split pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``
    over every row, and the id of spans that are special tokens (-1 elsewhere)."""
    none = np.zeros(0, np.int64)
    if not len(buf):
        return none, none, none.astype(np.int32)
    raw = buf.tobytes()
    points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((buf & 0xC0) != 0x80)  # byte position of each character
    kind = _char_class()[points] if len(points) != len(buf) else _char_class()[:128][points]
    n = len(points)
    cut = np.zeros(n + 1, bool)  # a segment (row, special token or text between) starts here
    cut[np.searchsorted(lead, offs)] = True
    marks: list[tuple[int, int, int]] = []
    for content, tid in special.items():
        code, at = content.encode(), raw.find(content.encode())
        while at >= 0:
            row = int(np.searchsorted(offs, at, "right")) - 1
            if at + len(code) <= offs[row + 1]:
                marks.append((at, at + len(code), tid))
                at = raw.find(code, at + len(code))
            else:
                at = raw.find(code, at + 1)
    marks.sort()
    fixed = np.zeros(n, bool)  # characters of special tokens
    for a, b, _ in marks:
        i, j = np.searchsorted(lead, (a, b))
        cut[i] = cut[j] = True
        fixed[i:j] = True
    begin = cut[:-1].copy()
    begin[1:] |= kind[1:] != kind[:-1]
    # The last white space before other text stands alone, or joins it when it is a blank.
    space = kind == SPACE
    before = np.zeros(n, bool)  # white space whose next character is other text of the segment
    before[:-1] = space[:-1] & ~space[1:] & ~cut[1:-1]
    begin |= before
    joins = np.flatnonzero(before & (points == 32)) + 1
    begin[joins] = False
    # Contractions: an apostrophe that starts a token, and one of the fixed endings.
    quote = np.flatnonzero((points == 39) & begin & ~fixed)
    if len(quote):
        tail = np.zeros(n + 3, np.uint32)
        tail[:n] = points
        seg = np.flatnonzero(cut)
        for end in CONTRACTIONS:
            q = quote[quote + len(end) < seg[np.searchsorted(seg, quote, "right")]]
            q = q[np.all([tail[q + 1 + i] == ord(c) for i, c in enumerate(end)], 0)] if len(q) else q
            begin[q + 1] = False
            stop = q + 1 + len(end)
            begin[stop[stop < n]] = True
            if len(end) == 2:
                begin[q + 2] = False
            quote = quote[~np.isin(quote, q)]
    if marks:
        begin &= ~fixed | cut[:-1]
    starts = lead[begin]
    ends = np.append(starts[1:], len(buf))
    ids = np.full(len(starts), -1, np.int32)
    if marks:
        at = np.searchsorted(starts, [m[0] for m in marks])
        ids[at] = [m[2] for m in marks]
    return starts, ends, ids


def _shared(df: DataFrame, tokenizer: str):
    with open(tokenizer, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(Vocabulary(f.read()))


def encode_column(vocab: Vocabulary, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a column, flat, and their offsets."""
    flat, ends, total = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0
    for _, _, b, o in tb.slices(*tb.string_buffers(column), SLICE):
        ids, offs = vocab.encode(b, o)
        flat.append(ids)
        ends.append(offs[1:] + total)
        total += len(ids)
    return np.concatenate(flat), np.concatenate(ends)


def encode(df: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "token_ids") -> DataFrame:
    """Append ``ids_col array<int>``: the ids of every whole text."""
    vocab = _shared(df, tokenizer)

    def ids(column):
        flat, ends = encode_column(vocab.value, column)
        return {ids_col: tb.list_array(flat, ends, pa.int32())}

    return tb.append_columns(df, text_col, ids, [T.StructField(ids_col, T.ArrayType(T.IntegerType()))])


def round_trip(df: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """Encode every text, decode the ids again, and append n_tokens and the digests of both:
    ids_sha256 (little-endian unsigned 32-bit) and decoded_sha256 (UTF-8). One pass; the ids
    themselves don't leave the task."""
    vocab = _shared(df, tokenizer)

    def digest(column):
        ids, offs = encode_column(vocab.value, column)
        raw, at = ids.astype("<u4").tobytes(), (offs * 4).tolist()
        out: list[str] = []
        for i in range(0, len(offs) - 1, 100):  # a hundred texts decoded at a time
            part = offs[i:i + 101]
            out += [hashlib.sha256(t.encode()).hexdigest() for t in vocab.value.decode(ids[part[0]:part[-1]], part - part[0])]
        return {"n_tokens": pa.array(np.diff(offs)),
                "ids_sha256": pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(at, at[1:])], pa.string()),
                "decoded_sha256": pa.array(out, pa.string())}

    return tb.append_columns(df, text_col, digest, [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
                                                    T.StructField("decoded_sha256", T.StringType())])


def decode(df: DataFrame, tokenizer: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """Append ``out_col string``: the text of every id array (null ids: null)."""
    vocab = _shared(df, tokenizer)

    def texts(column):
        flat, offs = id_rows(column)
        return {out_col: pa.array(vocab.value.decode(flat, offs), mask=np.asarray(column.is_null()))}

    return tb.append_columns(df, ids_col, texts, [T.StructField(out_col, T.StringType())])


def id_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, offsets) of an array<int> column; null rows are empty."""
    if column.null_count:
        column = pa.array([x or [] for x in column.to_pylist()], column.type)
    offs = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), offs - offs[0]
