"""Benchmark decontamination by winnowing.

For a span of ``s`` words, grams of ``k = (s + 1) // 2`` words are hashed and in
every window of ``s`` words the smallest gram hashes are kept as fingerprints, on
the benchmark and on the documents alike. Two texts that share ``s`` words in a row
share that window's smallest gram, so joining the two sets of fingerprints meets
every shared span. Each hit is then extended word by word to both sides; it counts
where it reaches ``s`` words. An item of 13 words or more has span 13, a shorter one
its own length.

Plan: the benchmark is a query set, taken in blocks of at most about
``BLOCK_WORDS`` words (a benchmark of that size is one block). The fingerprint index
of a block, its size thereby proven, is broadcast and joined inside one row-local
``mapInArrow`` pass over the documents: no shuffle of texts or fingerprints, no
group that a popular passage could make hot. Further blocks are further passes that
add to the same columns.

Defined results: null or wordless texts have no words and no hits; null or wordless
items take part in nothing; items with equal texts all count; a null item_id marks
words but isn't listed; repeated documents are judged alike; an empty benchmark
gives no hits; input columns named like the outputs are replaced, others kept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmetrics.llm import textbuf as tb

WINDOW = 13
BLOCK_WORDS = 1_000_000
COLUMNS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    T.StructField("items", T.ArrayType(T.LongType())),
]
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def slice_words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a slice and the first word of each row (+ total)."""
    starts, ends, rows = tb.word_spans(buf, offs, tb.ALNUM)
    return tb.span_hashes(buf, starts, ends, tb.LOWER), rows


def winnow(words: np.ndarray, left: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints (first word, gram hash) of all rows; ``left[i]``: words from i to the end of its row."""
    k = (span + 1) // 2
    w = span - k + 1
    grams = tb.gram_hashes(words, k)
    if len(grams) < w:
        return np.zeros(0, np.int64), np.zeros(0, tb.U64)
    least = tb.sliding_min(grams, w)
    whole = left[:len(least)] >= span
    # A gram is kept if it is the least of some window: then it equals the greatest of
    # the minima of the windows that hold it. Complemented, the greatest is a minimum.
    padded = np.full(len(grams) + w - 1, tb.U64(2**64 - 1))
    padded[w - 1:w - 1 + len(least)][whole] = ~least[whole]
    best = ~tb.sliding_min(padded, w)
    at = np.flatnonzero(grams == best)
    return at, grams[at]


def words_left(rows: np.ndarray) -> np.ndarray:
    """Number of words from each word to the end of its row."""
    return np.repeat(rows[1:], np.diff(rows)) - np.arange(rows[-1])


class Index:
    """Fingerprints of one block of the benchmark."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        by_words: dict[bytes, set] = {}
        for item, words in items:
            by_words.setdefault(words, set()).add(item)
        self.ids = [np.array(sorted(i for i in ids if i is not None), np.int64) for ids in by_words.values()]
        seqs = [np.frombuffer(w, tb.U64) for w in by_words]
        self.words = np.concatenate(seqs) if seqs else np.zeros(0, tb.U64)
        lens = np.array([len(s) for s in seqs], np.int64)
        self.first = np.concatenate(([0], np.cumsum(lens))).astype(np.int64)
        self.families = []
        spans = np.minimum(lens, WINDOW)
        for span in np.unique(spans).tolist():
            keys, at, seq = [], [], []
            for i in np.flatnonzero(spans == span):
                p, g = winnow(seqs[i], np.arange(lens[i], 0, -1), span)
                keys.append(g)
                at.append(p + self.first[i])
                seq.append(np.full(len(p), i))
            keys, at, seq = map(np.concatenate, (keys, at, seq))
            order = np.argsort(keys, kind="stable")
            keys, at, seq = keys[order], at[order], seq[order]
            bits = max(12, int(16 * len(keys)).bit_length())
            seen = np.zeros(1 << bits, bool)
            seen[(keys >> tb.U64(64 - bits)).astype(np.int64)] = True
            self.families.append((span, keys, at, seq, bits, seen))

    def probe(self, words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matched word ranges [a, b) of a slice and the sequence that each matches."""
        left = words_left(rows)
        before = np.arange(len(words)) - np.repeat(rows[:-1], np.diff(rows))
        out = [(np.zeros(0, np.int64),) * 3]
        for span, keys, at, seq, bits, seen in self.families:
            p, g = winnow(words, left, span)
            maybe = seen[(g >> tb.U64(64 - bits)).astype(np.int64)]
            p, g = p[maybe], g[maybe]
            lo, hi = np.searchsorted(keys, g), np.searchsorted(keys, g, "right")
            n = hi - lo
            post = tb.ragged(lo, n)
            p, q, s = np.repeat(p, n), at[post], seq[post]
            k = (span + 1) // 2
            lefts = np.zeros(len(p), np.int64)
            rights = np.zeros(len(p), np.int64)
            same = np.ones(len(p), bool)
            for j in range(k):  # the gram itself, word by word
                same &= (p + j < len(words)) & (self.words[q + j] == words[np.minimum(p + j, len(words) - 1)])
            for room, steps, sign, base in ((np.minimum(before[p], q - self.first[s]), lefts, -1, 0),
                                            (np.minimum(left[p], self.first[s + 1] - q) - k, rights, 1, k - 1)):
                on = np.flatnonzero(same & (room > 0))
                for j in range(1, span - k + 1):
                    on = on[room[on] >= j]
                    on = on[words[p[on] + base + sign * j] == self.words[q[on] + base + sign * j]]
                    steps[on] = j
            full = same & (lefts + k + rights >= span)
            out.append(((p - lefts)[full], (p + k + rights)[full], s[full]))
        return tuple(np.concatenate(x) for x in zip(*out))


def marked(words: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of ``words`` words lie in any of the ranges."""
    step = np.bincount(a, minlength=words + 1) - np.bincount(b, minlength=words + 1)
    return np.cumsum(step[:words]) > 0


def search(index: Index, column: pa.Array, old: tuple[pa.Array, pa.Array] | None) -> dict:
    buf, offs = tb.string_buffers(column)
    n_words, n_hit, spans, items = [], [], [], []
    had_spans, had_items = (x.to_pylist() for x in old) if old else (None, None)
    for lo, hi, b, o in tb.slices(buf, offs):
        words, rows = slice_words(b, o)
        a, e, s = index.probe(words, rows)
        doc = np.searchsorted(rows, a, "right") - 1
        new_items: dict[int, set] = {}
        for d, q in sorted(set(zip(doc.tolist(), s.tolist()))):
            new_items.setdefault(d, set()).update(index.ids[q].tolist())
        if old:
            for d in range(hi - lo):
                new_items.setdefault(d, set()).update(had_items[lo + d])
            more = [(rows[d] + x["start"], rows[d] + x["end"]) for d in range(hi - lo) for x in had_spans[lo + d]]
            if more:
                a, e = (np.concatenate((y, z)) for y, z in zip((a, e), np.array(more, np.int64).T))
        hit = marked(len(words), a, e)
        total = np.concatenate(([0], np.cumsum(hit)))
        n_words.append(np.diff(rows))
        n_hit.append(np.diff(total[rows]))
        slot = [[] for _ in range(hi - lo)]
        if hit.any():
            edge = hit.copy()
            edge[1:] &= ~hit[:-1]
            cut = rows[(rows > 0) & (rows < len(words))]
            edge[cut] = hit[cut]
            begin = np.flatnonzero(edge)
            gone = np.flatnonzero(~hit)
            for x in begin.tolist():
                d = int(np.searchsorted(rows, x, "right")) - 1
                nxt = np.searchsorted(gone, x)
                stop = min(int(gone[nxt]) if nxt < len(gone) else len(words), int(rows[d + 1]))
                slot[d].append({"start": x - int(rows[d]), "end": stop - int(rows[d])})
        spans += slot
        items += [sorted(new_items.get(d, ())) for d in range(hi - lo)]
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return {"n_words": pa.array(cat(n_words), pa.int64()), "n_hit": pa.array(cat(n_hit), pa.int64()),
            "hit_spans": pa.array(spans, SPANS), "items": pa.array(items, pa.list_(pa.int64()))}


def benchmark_words(benchmark: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(item_id, words: hashes as binary, n) of the items that have words."""
    def words(batch):
        buf, offs = tb.string_buffers(batch.column(1))
        out, n = [], []
        for _, _, b, o in tb.slices(buf, offs):
            h, rows = slice_words(b, o)
            out += [h[i:j].tobytes() for i, j in zip(rows, rows[1:])]
            n += np.diff(rows).tolist()
        return {"item_id": batch.column(0), "words": pa.array(out, pa.binary()), "n": pa.array(n, pa.int64())}

    fields = [T.StructField("item_id", T.LongType()), T.StructField("words", T.BinaryType()), T.StructField("n", T.LongType())]
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    return tb.map_arrow(rows, words, fields).where("n > 0")


def find_contamination(documents: DataFrame, benchmark: DataFrame, text_col: str = "text", bench_text: str = "text",
                       bench_id: str = "item_id", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Append n_words, n_hit, hit_spans (word ranges) and items (sorted item ids) to every document."""
    sc = documents.sparkSession.sparkContext
    prepared = benchmark_words(benchmark, bench_text, bench_id)
    total = prepared.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, math.ceil(total / block_words))
    out, names = documents, {f.name for f in COLUMNS}
    kept = [c for c in documents.columns if c not in names]
    for block in range(blocks):
        rows = prepared.where(F.pmod(F.xxhash64("words", "item_id"), F.lit(blocks)) == block).select("item_id", "words")
        index = sc.broadcast(Index([(r[0], bytes(r[1])) for r in rows.collect()]))
        source = out.select(*[f"`{c}`" for c in kept], *(["hit_spans", "items"] if block else []))
        at, n = kept.index(text_col), len(kept)

        def run(batch, index=index, block=block):
            found = search(index.value, batch.column(at), (batch.column(n), batch.column(n + 1)) if block else None)
            return {c: batch.column(i) for i, c in enumerate(kept)} | found

        out = tb.map_arrow(source, run, [documents.schema[c] for c in kept] + COLUMNS)
    return out


def contaminated():
    """The contract's rule: at least one word in twenty is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
