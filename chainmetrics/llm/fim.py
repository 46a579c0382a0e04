"""Fill-in-the-middle transformation of texts, cut at unit boundaries.

Every text is cut into prefix, middle and suffix at two boundaries between units (lines,
or words with the blank after them) and written as ``<P>prefix<S>suffix<M>middle`` (psm) or
``<S>suffix<P>prefix<M>middle`` (spm), so that a left-to-right model learns to fill a gap.

The cuts come from a wavelet matrix over character classes. The bytes of a slice of texts
are classed (other, newline, blank, continuation byte); the matrix keeps one bit vector per
bit of the class, each level stably parted by the bit before, with a popcount directory, so
``rank(class, i)`` takes two look-ups per level for any number of positions at once. Ranks
of the classes that end a unit add up to the number of unit ends before a position; bisection
on that sum (a select) finds the byte after the k-th unit for all texts of a slice
together, and positions less the rank of continuation bytes are lengths in code points.

Draws come from the sha256 of ``seed:key``, so they depend on the row's key alone: reruns,
other partitionings and other rows change nothing. The transformation is row-local: one
``mapInArrow`` pass, no shuffle, a slice of about a quarter of a megabyte (or one longer
text) at a time. ``restore`` rebuilds the text from output and form with SQL functions.

Defined results: null text is empty; an empty text, one that holds a sentinel, and one that
isn't drawn (``percent``) stay as they are (form ``plain``, no cuts); a null key is drawn
as the empty string; very long texts are cut whole, in one slice of their own; cuts may fall
together or at either end, which leaves empty parts; repeated rows get equal results; an
empty table gives an empty table; input columns are kept, those named like an output are
replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmetrics.llm import textbuf as tb

OTHER, NEWLINE, BLANK, CONTINUATION = range(4)
_CLASS = np.zeros(256, np.uint8)
_CLASS[10] = NEWLINE
_CLASS[[9, 11, 12, 13, 32]] = BLANK
_CLASS[128:192] = CONTINUATION

#: Classes of which a byte ends a unit.
UNITS = {"line": (NEWLINE,), "word": (NEWLINE, BLANK)}
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class BitVector:
    """Bits with the number of ones before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros(len(bits) // 64 * 8 + 8, np.uint8)
        some = np.packbits(bits, bitorder="little")
        packed[:len(some)] = some
        self.words = packed.view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Ranks of every symbol of a sequence over 2**bits symbols."""

    def __init__(self, symbols: np.ndarray, bits: int = 2):
        self.levels = []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1 == 1
            self.levels.append((BitVector(bit), len(bit) - int(np.count_nonzero(bit))))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def rank(self, symbol: int, i: np.ndarray) -> np.ndarray:
        """Occurrences of the symbol before each position."""
        start, end = np.zeros_like(i), i
        for level, (vector, zeros) in zip(range(len(self.levels) - 1, -1, -1), self.levels):
            a, b = vector.rank(start), vector.rank(end)
            if symbol >> level & 1:
                start, end = zeros + a, zeros + b
            else:
                start, end = start - a, end - b
        return end - start

    def ranks(self, symbols: tuple[int, ...], i: np.ndarray) -> np.ndarray:
        return sum(self.rank(s, i) for s in symbols)

    def select_end(self, symbols: tuple[int, ...], wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest position p in [low, high] with at least ``wanted`` of the symbols before it
        (high, if there are fewer), by bisection on the ranks of all rows at once."""
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            mid = (low + high) >> 1
            enough = self.ranks(symbols, mid) >= wanted
            high = np.where(open_ & enough, mid, high)
            low = np.where(open_ & ~enough, mid + 1, low)
        return low


def locate_cuts(buf: np.ndarray, offs: np.ndarray, h1: np.ndarray, h2: np.ndarray, unit: str = "line") -> dict[str, np.ndarray]:
    """Units of each text, byte positions of both cuts, and code points of prefix and middle.

    The cuts come after the smaller and the larger of ``h1 % (n + 1)`` and ``h2 % (n + 1)`` units."""
    ends = UNITS[unit]
    wm = WaveletMatrix(_CLASS[buf])
    lo, hi = offs[:-1], offs[1:]
    before = wm.ranks(ends, lo)
    closed = wm.ranks(ends, hi) - before
    # A last unit without its end counts, too.
    last = np.maximum(hi - 1, 0)
    open_end = (hi > lo) & (wm.ranks(ends, hi) == wm.ranks(ends, last))
    n = closed + open_end
    first, second = np.sort(np.stack((h1 % (n + 1), h2 % (n + 1))), axis=0)
    out = {"n": n}
    for name, k in (("cut1", first), ("cut2", second)):
        at = wm.select_end(ends, before + k, lo, hi)
        out[name] = np.where(k == 0, lo, at)
    chars = [p - wm.rank(CONTINUATION, p) for p in (lo, out["cut1"], out["cut2"])]
    return out | {"prefix_chars": chars[1] - chars[0], "middle_chars": chars[2] - chars[1]}


def transform(df: DataFrame, key_col: str = "doc_id", text_col: str = "text", seed: int = 7, percent: int = 100,
              spm_percent: int = 50, unit: str = "line") -> DataFrame:
    """Append n (units), form (plain, psm, spm), prefix_chars, middle_chars and output."""
    if unit not in UNITS:
        raise ValueError(f"unit is one of {sorted(UNITS)}")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key_col).cast("string"), F.lit(""))).cast("binary"), 256)
    draws = F.array(*[F.conv(F.substring(digest, 1 + 8 * j, 8), 16, 10).cast("long") for j in range(4)])
    fields = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
              T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]
    new = {f.name for f in fields}
    kept = [f for f in df.schema.fields if f.name not in new]
    if text_col in new or len({f.name for f in kept}) != len(kept):
        raise ValueError("the text column is an output, or columns are ambiguous")
    # The draws travel as the last column; its name may be any, as it is read by position.
    given = df.select(*[f"`{f.name}`" for f in kept], draws)
    at = [f.name for f in kept].index(text_col)

    def run(batch):
        buf, offs = tb.string_buffers(batch.column(at))
        h = batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(-1, 4)
        parts = [_rows(b, o, h[lo:hi], unit, percent, spm_percent) for lo, hi, b, o in tb.slices(buf, offs)]
        joined = {f.name: pa.concat_arrays([p[f.name] for p in parts]) for f in fields}
        return {f.name: batch.column(i) for i, f in enumerate(kept)} | joined

    return tb.map_arrow(given, run, kept + fields)


def _rows(buf: np.ndarray, offs: np.ndarray, h: np.ndarray, unit: str, percent: int, spm_percent: int) -> dict[str, pa.Array]:
    cuts = locate_cuts(buf, offs, h[:, 0], h[:, 1], unit)
    raw, p, s, m = buf.tobytes(), PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    forms, outputs = [], []
    for i, (lo, a, b, hi) in enumerate(zip(offs[:-1].tolist(), cuts["cut1"].tolist(), cuts["cut2"].tolist(), offs[1:].tolist())):
        text = raw[lo:hi]
        if not text or h[i, 2] % 100 >= percent or p in text or s in text or m in text:
            forms.append("plain")
            outputs.append(text)
        elif h[i, 3] % 100 < spm_percent:
            forms.append("spm")
            outputs.append(b"".join((s, raw[b:hi], p, raw[lo:a], m, raw[a:b])))
        else:
            forms.append("psm")
            outputs.append(b"".join((p, raw[lo:a], s, raw[b:hi], m, raw[a:b])))
    plain = np.array([f == "plain" for f in forms])
    return {"n": pa.array(cuts["n"], pa.int64()), "form": pa.array(forms, pa.string()),
            "prefix_chars": pa.array(cuts["prefix_chars"], pa.int64(), mask=plain),
            "middle_chars": pa.array(cuts["middle_chars"], pa.int64(), mask=plain),
            "output": pa.array(outputs, pa.binary()).cast(pa.string())}


def restore(df: DataFrame, output_col: str = "output", form_col: str = "form", into: str = "restored") -> DataFrame:
    """Append the text rebuilt from output and form alone.

    No part holds a sentinel and no sentinel begins inside another, so each one's first
    occurrence is the one that was written."""
    out, psm = F.col(output_col), F.col(form_col) == "psm"

    def after(column, skipped):
        return column.substr(skipped + F.lit(len(PREFIX) + 1), F.length(column))

    body = after(out, F.lit(0))
    first = F.when(psm, F.substring_index(body, SUFFIX, 1)).otherwise(F.substring_index(body, PREFIX, 1))
    rest = after(body, F.length(first))
    second = F.substring_index(rest, MIDDLE, 1)
    middle = after(rest, F.length(second))
    text = F.when(psm, F.concat(first, middle, second)).otherwise(F.concat(second, middle, first))
    return df.withColumn(into, F.when(F.col(form_col) == "plain", out).otherwise(text))
