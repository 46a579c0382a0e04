"""Vectorised text helpers that work on Arrow string buffers inside tasks.

A batch of texts is one UTF-8 byte array plus offsets; words, hashes and
windows are computed with numpy over the whole array, never per character in
Python. ``slices`` bounds the working set: texts are taken a quarter of a megabyte at a
time (one longer text is a slice of its own).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE_BYTES = 256 << 10
U64 = np.uint64

#: Odd multiplier of the polynomial hashes, modulo 2**64.
HASH_BASE = 0x9E3779B97F4A7C13

_powers = np.ones(1, U64)


def powers(n: int) -> np.ndarray:
    """HASH_BASE ** 0 .. n-1 modulo 2**64."""
    global _powers
    if len(_powers) < n:
        size = 1 << max(10, int(n - 1).bit_length())
        steps = np.full(size, HASH_BASE, U64)
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the output (a new array)."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def byte_class(members: Callable[[int], bool]) -> np.ndarray:
    return np.array([members(b) for b in range(256)])


#: Byte translation that folds ASCII A-Z to a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words of the contamination contract: digits, ASCII letters and all bytes from 0x80 on.
ALNUM = byte_class(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
#: Words of the near-duplicate and language-model contracts: anything but ASCII white space.
NONSPACE = byte_class(lambda b: not (b == 32 or 9 <= b <= 13))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offs = np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def slices(buf: np.ndarray, offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows [lo, hi) holding about ``limit`` bytes, with their own bytes and offsets."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def word_spans(buf: np.ndarray, offs: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row + total). Words never cross rows."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    inside = word_bytes[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offs[(offs > 0) & (offs < len(buf))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs)


_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], U64)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes at a time; ``fold`` translates bytes first."""
    if not len(starts):
        return np.zeros(0, U64)
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[:len(buf)] = buf if fold is None else fold[buf]
    words = np.ndarray((len(buf) + 1,), "<u8", padded, 0, (1,))  # the 8 bytes from each position on
    lens = ends - starts
    h = words[starts] & _MASKS[np.minimum(lens, 8)]
    h = mix(h + lens.astype(U64) * U64(HASH_BASE))
    done, at = 8, np.flatnonzero(lens > 8)
    while len(at):
        more = words[starts[at] + done] & _MASKS[np.minimum(lens[at] - done, 8)]
        h[at] = mix(h[at] * U64(HASH_BASE) + more)
        done += 8
        at = at[lens[at] > done]
    return h


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (len(words)-k+1 values)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    h = words[:n].copy()
    for j in range(1, k):
        h *= U64(HASH_BASE)
        h += words[j:j + n]
    return mix(h)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, by doubling."""
    m, size = x, 1
    while size * 2 <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    if size < w:
        m = np.minimum(m[:len(m) - (w - size)], m[w - size:])
    return m


class HashTable:
    """Positions of distinct 64-bit keys: open addressing, probed for many keys at once."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(10, int(8 * len(keys)).bit_length())
        self.keys = np.append(keys.astype(U64), U64(2**64 - 1))
        self.slots = np.full(1 << self.bits, -1, np.int32)
        todo, self.probes = np.arange(len(keys)), 0
        while len(todo):
            slot = (self._slot(self.keys[todo]) + self.probes) & ((1 << self.bits) - 1)
            first = np.zeros(len(todo), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = (self.slots[slot] < 0) & first
            self.slots[slot[put]] = todo[put]
            todo, self.probes = todo[~put], self.probes + 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 if it isn't there."""
        slot = self._slot(keys)
        got = self.slots[slot]
        unsure = np.flatnonzero((got >= 0) & (self.keys[got] != keys))
        for p in range(1, self.probes):
            if not len(unsure):
                break
            g = self.slots[(slot[unsure] + p) & ((1 << self.bits) - 1)]
            got[unsure] = g
            unsure = unsure[(g >= 0) & (self.keys[g] != keys[unsure])]
        got[unsure] = -1
        return got


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of the index ranges [start, start + count)."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def bounded_batches(spark: SparkSession) -> None:
    """Hand texts to Python a few megabytes at a time (Spark's default is 10,000 rows,
    which for long texts is more than a worker's share of an executor)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | list], fields: list[T.StructField]) -> DataFrame:
    """``mapInArrow`` with one output batch (dict of arrays) per input batch."""
    bounded_batches(df.sparkSession)
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None:
                    pa.default_memory_pool().release_unused()
                    yield pa.RecordBatch.from_arrays(
                        [a.cast(f.type) if a.type != f.type else a for f in arrow
                         for a in [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type)]],
                        schema=arrow)

    return df.mapInArrow(run, schema)


def append_columns(df: DataFrame, text_col: str, fn: Callable[[pa.Array], dict], fields: list[T.StructField]) -> DataFrame:
    """Row-preserving map: keeps every column and appends those ``fn`` returns for the
    text column. A column of ``df`` with the name of a new one is replaced."""
    new = {f.name for f in fields}
    kept = [f for f in df.schema.fields if f.name not in new]
    if text_col in new:
        raise ValueError(f"{text_col} is both read and written")
    names = [f.name for f in kept]
    if len(set(names)) != len(names):
        raise ValueError(f"ambiguous columns: {names}")

    def batch_fn(batch):
        out = fn(batch.column(names.index(text_col)))
        return {n: batch.column(i) for i, n in enumerate(names)} | out

    return map_arrow(df.select(*[f"`{n}`" for n in names]), batch_fn, kept + fields)


def list_array(flat: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))
