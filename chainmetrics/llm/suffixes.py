"""Removal of repeated 100-byte strings by a logarithmic family of suffix arrays.

Sparse suffixes. In every window of ``SPAN`` bytes the ``GRAM``-byte gram with the
least hash (the leftmost of equals) is its anchor. Equal windows have their anchor at the
same place, so it is enough to index the suffixes that begin at anchors, about one in
35 bytes. A suffix entry stands for the run of consecutive windows that share its anchor:

    key   hash of the anchor gram, the head of the suffix
    body  hash of all bytes of the run's windows and the anchor's place in them
    doc, start (of the first window), n (windows of the run)

A suffix array is the entries in the order of (key, body, doc, start). It orders suffixes
by a hash of their head instead of the bytes: long matches only need equal heads to be
neighbours, and ranges of hashes are even whatever the text.

Family. Each batch of documents, taken in id order, gets its suffix array and is
merge-scanned against the levels. Where key and body occur before, all windows of the run
are repeats. Where the key occurs with another body, some windows may be: the key is
noted as contested. What a batch adds (first bodies) becomes a level; levels of equal
size merge, so n batches make log n levels. Levels are tables in the shared folder.

Contested keys, collected over all batches as a bit filter of fixed size
(``FILTER_BITS``; false positives cost time only), are settled window by window: the texts
are read once more and every window of such a run is looked up by its own hash.

A task sends each body, and each window, at most once: further copies within its input
are repeats of that one whatever else holds, so copies of one text or passage, however
many, meet as one row per task. Hashes are 128 bits taken together (key with body or
window).

Defined results: null text is empty; texts under 100 bytes have nothing removed; rows
that share an id are one document for the order (neither repeats the other by that
alone); a null id comes before all others; an empty table gives an empty table; other
columns are ignored; texts of any length are treated whole.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from chainmetrics.llm import textbuf as tb
from chainmetrics.session import scratch_path

SPAN = 100
GRAM = 32
FILTER_BITS = 27
BATCH_BYTES = 32 << 30
BATCHES = 2

_A, _B, _C = tb.U64(0x9E3779B97F4A7C15), tb.U64(0xD6E8FEB86659FD93), tb.U64(0xA0761D6478BD642F)


def gram_table(buf: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each position on."""
    n = len(buf) - GRAM + 1
    eight = np.ndarray((len(buf) - 7,), "<u8", np.ascontiguousarray(buf), 0, (1,)).copy()
    x = eight[:-8] * _A + eight[8:]
    x ^= x >> tb.U64(29)
    x *= _B
    y = x[:n] * _C + x[16:16 + n]
    y ^= y >> tb.U64(32)
    y *= _A
    y ^= y >> tb.U64(29)
    return y


def runs(buf: np.ndarray, offs: np.ndarray):
    """Runs of windows with one anchor: (grams, row, first window, windows, anchor), positions in the slice."""
    none = np.zeros(0, np.int64)
    if len(buf) < SPAN:
        return np.zeros(0, tb.U64), none, none, none, none
    grams = gram_table(buf)
    at = np.arange(len(grams), dtype=np.uint64)
    least = tb.sliding_min((grams & tb.U64(0xFFFFFFFF00000000)) | at, SPAN - GRAM + 1)
    anchor = (least & tb.U64(0xFFFFFFFF)).astype(np.int64)
    # Windows inside of one row only.
    room = np.diff(offs) - SPAN + 1
    rows = np.flatnonzero(room > 0)
    window = tb.ragged(offs[rows], room[rows])
    owner = np.repeat(rows, room[rows])
    anchor = anchor[window]
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    return grams, owner[head], window[head], np.diff(np.append(head, len(window))), anchor[head]


def bodies(grams: np.ndarray, first: np.ndarray, n: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Hash of all bytes of each run's windows, its length and the anchor's place."""
    end = first + n - 1 + SPAN - GRAM
    h = (n * 256 + (anchor - first)).astype(tb.U64)
    for x in (first, first + GRAM, first + 2 * GRAM, end - 2 * GRAM, end - GRAM, end):
        h = (h ^ grams[x]) * _B
        h ^= h >> tb.U64(31)
    return tb.mix(h)


def window_hashes(grams: np.ndarray, window: np.ndarray) -> np.ndarray:
    h = np.zeros(len(window), tb.U64)
    for x in (0, GRAM, 2 * GRAM, SPAN - GRAM):
        h = (h ^ grams[window + x]) * _C
        h ^= h >> tb.U64(31)
    return tb.mix(h)


ENTRY = T.StructType([T.StructField("key", T.LongType()), T.StructField("body", T.LongType()), T.StructField("doc", T.LongType()),
                      T.StructField("start", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("kind", T.ByteType())])
#: Kinds of rows: an entry of the batch, one of a level, a repeat known within its task;
#: and of the results: repeats, runs to be settled by window, entries of the new level.
OWN, OLD, COPY, FULL, CONTESTED, LEVEL = range(6)


def _batch(schema: T.StructType, *columns) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(tb.U64).view(np.int64)


class Sent:
    """First places of the bodies that a task has sent: a further copy shares key and body."""

    def __init__(self):
        self.body, self.key = np.zeros(0, tb.U64), np.zeros(0, tb.U64)
        self.doc, self.start = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def copies(self, key: np.ndarray, body: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """An order of the entries and, in that order, which of them repeat one of this call or of those before."""
        order = np.lexsort((start, doc, key, body))
        key, body, doc, start = (x[order] for x in (key, body, doc, start))
        head = np.ones(len(body), bool)
        head[1:] = (body[1:] != body[:-1]) | (key[1:] != key[:-1])
        lead = np.maximum.accumulate(np.where(head, np.arange(len(body)), 0))
        copy = (doc != doc[lead]) | (start != start[lead])
        if len(self.body):
            at = np.minimum(np.searchsorted(self.body, body), len(self.body) - 1)
            copy |= ((self.body[at] == body) & (self.key[at] == key)
                     & ((self.doc[at] < doc) | (self.doc[at] == doc) & (self.start[at] < start)))
        new = head & ~copy
        # One key is kept for a body: an entry of another key is sent itself and meets its copies later.
        self.body, where = np.unique(np.concatenate((body[new], self.body)), return_index=True)
        self.key, self.doc, self.start = (np.concatenate(x)[where] for x in ((key[new], self.key), (doc[new], self.doc), (start[new], self.start)))
        return order, copy


def entries(docs: DataFrame) -> DataFrame:
    """Suffix entries of a batch of documents (doc, text); further copies within a task are COPY."""
    tb.bounded_batches(docs.sparkSession)

    def run(batches):
        sent = Sent()
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            buf, offs = tb.string_buffers(batch.column(1))
            parts = []
            for lo, _, b, o in tb.slices(buf, offs):
                grams, row, first, n, anchor = runs(b, o)
                if len(first):
                    parts.append((grams[anchor], bodies(grams, first, n, anchor), ids[lo + row], first - o[row], n))
            if not parts:
                continue
            key, body, doc, start, n = map(np.concatenate, zip(*parts))
            order, copy = sent.copies(key, body, doc, start)
            key, body, doc, start, n = (x[order] for x in (key, body, doc, start, n))
            # Copies only pass through: they are spread evenly and bring no hashes along.
            key = np.where(copy, tb.mix((doc * 1000003 + start).astype(tb.U64)) >> tb.U64(40), key)
            yield _batch(ENTRY, _signed(key), _signed(np.where(copy, tb.U64(0), body)), doc, start, n, np.where(copy, COPY, OWN))

    return docs.mapInArrow(run, ENTRY)


def merge_scan(rows: DataFrame, keep: bool) -> DataFrame:
    """Scan entries of a batch and of the levels, merged in suffix order: FULL, CONTESTED and
    (``keep``) LEVEL rows. Streams over the sorted rows; at most one entry is held back."""
    ordered = rows.repartition("key").sortWithinPartitions("key", "body", "doc", "start", "kind")

    def run(batches):
        held = None  # (key, body, doc, start, n, whether the key is known as contested, first of its body)
        for batch in batches:
            key, body, doc, start, n, kind = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            passed = kind == COPY
            out = [(doc[passed], start[passed], n[passed], np.zeros(passed.sum(), np.int64), np.zeros(passed.sum(), np.int64), np.full(passed.sum(), FULL))]
            key, body, doc, start, n, kind = (x[~passed] for x in (key, body, doc, start, n, kind))
            if len(key):
                known, sent = False, 0
                if held and held[0] == key[0]:  # the last entry of the batch before goes first
                    key, body, doc, start, n = (np.concatenate(([h], x)) for h, x in zip(held[:5], (key, body, doc, start, n)))
                    kind = np.concatenate(([OLD], kind))
                    known, sent = held[5], 1
                new_key = np.ones(len(key), bool)
                new_key[1:] = key[1:] != key[:-1]
                head = new_key.copy()
                head[1:] |= body[1:] != body[:-1]
                lead = np.maximum.accumulate(np.where(head, np.arange(len(key)), 0))
                full = (kind == OWN) & ((doc != doc[lead]) | (start != start[lead]))
                group = np.cumsum(new_key) - 1
                several = np.bincount(group, head) > 1
                if known:
                    several[0] = True
                contested = head & several[group]
                if sent and known:
                    contested[0] = False  # it was sent with the batch before
                level = head & (kind == OWN) if keep else np.zeros(len(key), bool)
                for mask, what in ((full, FULL), (contested, CONTESTED), (level, LEVEL)):
                    # A row that opens a body of the last key may turn out as contested later; it is held below.
                    named = what != FULL
                    out.append((doc[mask], start[mask], n[mask], key[mask] if named else np.zeros(mask.sum(), np.int64),
                                body[mask] if what == LEVEL else np.zeros(mask.sum(), np.int64), np.full(mask.sum(), what)))
                last = lead[-1]
                held = (key[last], body[last], doc[last], start[last], n[last], bool(several[group[-1]]))
            doc, start, n, key, body, kind = map(np.concatenate, zip(*out))
            if len(doc):
                yield _batch(ENTRY, key, body, doc, start, n, kind)

    return ordered.mapInArrow(run, ENTRY)


#: Result rows as stored, by kind.
STORED = T.StructType([f for f in ENTRY if f.name != "kind"] + [T.StructField("kind", T.IntegerType())])


class Family:
    """Levels of a logarithmic index of suffix arrays: (size in batches, path of the level's table)."""

    def __init__(self, spark):
        self.spark, self.levels, self.results = spark, [], []

    def add(self, docs: DataFrame, keep: bool = True) -> None:
        """Scan a batch (doc, text; ids after those of all batches before) against the levels and itself.

        ``keep``: whether more batches follow, so that the batch becomes a level."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            self._merge()
        rows = entries(docs)
        for _, path in self.levels:
            rows = rows.unionByName(self._read([path], LEVEL).withColumn("kind", F.lit(OLD).cast("byte")))
        path = scratch_path(self.spark, "suffix-scan")
        merge_scan(rows, keep).write.partitionBy("kind").parquet(path)
        self.results.append(path)
        if keep:
            self.levels.append((1, path))

    def _read(self, paths: list[str], kind: int) -> DataFrame:
        tables = [self.spark.read.schema(STORED).parquet(p).where(F.col("kind") == kind) for p in paths]
        return reduce(DataFrame.unionByName, tables)

    def _merge(self) -> None:
        """Two levels of equal size become one, in suffix order."""
        (size, a), (_, b) = self.levels.pop(), self.levels.pop()
        path = scratch_path(self.spark, "suffix-level")
        (self._read([a, b], LEVEL).repartition("key").sortWithinPartitions("kind", "key", "body", "doc", "start")
         .write.partitionBy("kind").parquet(path))
        self.levels.append((2 * size, path))

    def rows(self, kind: int) -> DataFrame:
        """Results of one kind over all batches (key, doc, start, n)."""
        return self._read(self.results, kind)


def place_bits(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Two bits of the filter for each place, one column each."""
    h = tb.mix(doc.astype(np.int64).view(tb.U64) * _A + start.astype(np.int64).view(tb.U64))
    return np.stack((h >> tb.U64(64 - FILTER_BITS), (h * _B) >> tb.U64(64 - FILTER_BITS)), 1).astype(np.int64)


def place_filter(places: DataFrame) -> np.ndarray:
    """Bit filter of the (doc, start) places: a table of fixed size, whatever their number."""
    page = 16  # bits of the position inside a page

    def bits(batch):
        at = np.unique(place_bits(batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        return {"page": pa.array(at >> page), "bit": pa.array(at & ((1 << page) - 1))}

    def pages(group: pa.Table) -> pa.Table:
        out = np.zeros(1 << page, bool)
        out[group.column("bit").to_numpy()] = True
        return pa.table({"page": group.column("page")[:1], "data": pa.array([np.packbits(out).tobytes()], pa.binary())})

    found = tb.map_arrow(places.select("doc", "start"), bits, [T.StructField("page", T.LongType()), T.StructField("bit", T.LongType())])
    got = found.distinct().groupBy("page").applyInArrow(pages, "page long, data binary").toArrow()
    out = np.zeros((1 << (FILTER_BITS - page), 1 << (page - 3)), np.uint8)
    for p, data in zip(got.column("page").to_pylist(), got.column("data").to_pylist()):
        out[p] = np.frombuffer(data, np.uint8)
    return out.ravel()


RUN = T.StructType([T.StructField("key", T.LongType()), T.StructField("doc", T.LongType()), T.StructField("start", T.LongType()),
                    T.StructField("bytes", T.BinaryType())])
SPANS = T.StructType([T.StructField("doc", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n", T.IntegerType())])
#: Runs of one key settled by one group; further groups take other windows of the same runs.
HOT = 20_000


def contested_runs(docs: DataFrame, shared) -> DataFrame:
    """Key, place and bytes of the runs whose places are in the filter."""
    tb.bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            buf, offs = tb.string_buffers(batch.column(1))
            for lo, _, b, o in tb.slices(buf, offs):
                grams, row, first, n, anchor = runs(b, o)
                if not len(first):
                    continue
                doc, start = ids[lo + row], first - o[row]
                at = place_bits(doc, start)
                hit = np.flatnonzero(((shared.value[at >> 3] >> (7 - (at & 7))) & 1).all(1))
                if len(hit):
                    end = first[hit] + n[hit] - 1 + SPAN
                    yield _batch(RUN, _signed(grams[anchor[hit]]), doc[hit], start[hit], [b[x:y].tobytes() for x, y in zip(first[hit], end)])

    return docs.mapInArrow(run, RUN)


def settle(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Repeated windows of contested runs, as (doc, start, n). Streams over the runs of a key in
    order of place and holds the key's distinct window hashes; keys with more than HOT runs
    are dealt to several groups, each with its share of the windows."""
    shares = counts.where(F.col("count") > HOT).select("key", F.ceil(F.col("count") / HOT).cast("int").alias("shares"))
    dealt = (found.join(shares, "key", "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
             .withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
             .select("key", "share", "shares", "doc", "start", "bytes")
             .repartition("key", "share").sortWithinPartitions("key", "share", "doc", "start"))

    def run(batches):
        last, seen = None, np.zeros(0, tb.U64)
        for batch in batches:
            key, share, shares, doc, start = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            data = batch.column(5)
            offs = np.frombuffer(data.buffers()[1], np.int32, len(data) + 1, data.offset * 4).astype(np.int64)
            buf = np.frombuffer(data.buffers()[2], np.uint8)[offs[0]:offs[-1]]
            offs = offs - offs[0]
            n = np.diff(offs) - SPAN + 1
            window = tb.ragged(offs[:-1], n)
            row = np.repeat(np.arange(len(n)), n)
            h = window_hashes(gram_table(buf), window)
            mine = h % shares[row].astype(tb.U64) == share[row].astype(tb.U64)
            window, row, h = window[mine], row[mine], h[mine]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (share[1:] != share[:-1])
            group = np.cumsum(new) - 1
            order = np.lexsort((np.arange(len(h)), h, group[row]))
            again = np.zeros(len(h), bool)
            a, b = order[1:], order[:-1]
            # The same place under one key twice (a repeated row) is no repeat.
            same = (h[a] == h[b]) & (group[row[a]] == group[row[b]])
            lead = np.maximum.accumulate(np.where(np.append(True, ~same), np.arange(len(h)), 0)) if len(h) else np.zeros(0, np.int64)
            first = order[lead]
            where = lambda x: (doc[row[x]], start[row[x]] + window[x] - offs[row[x]])
            (d0, s0), (d1, s1) = where(first), where(order)
            again[order] = (d0 != d1) | (s0 != s1)
            current = (key[0], share[0])
            if last == current and len(seen):
                in_first = group[row] == 0
                again |= in_first & np.isin(h, seen)
            tail = h[group[row] == group[-1]]
            seen = np.union1d(seen, tail) if last == (key[-1], share[-1]) else np.unique(tail)
            last = (key[-1], share[-1])
            if again.any():
                at = np.flatnonzero(again)
                r, place = row[at], window[at] - offs[row[at]]
                cut = np.ones(len(at), bool)
                cut[1:] = (r[1:] != r[:-1]) | (place[1:] != place[:-1] + 1)
                begin = np.flatnonzero(cut)
                yield _batch(SPANS, doc[r[begin]], start[r[begin]] + place[begin], np.diff(np.append(begin, len(at))))

    return dealt.mapInArrow(run, SPANS)


def repeated_spans(docs: DataFrame, batch_bytes: int = BATCH_BYTES, least: int = BATCHES) -> DataFrame:
    """(doc, start, n): runs of windows that occur earlier. ``docs``: doc, text (not null).

    The table is added to a family in batches of equal numbers of ids: ``least`` of them, or
    as many as keep them to about ``batch_bytes``."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(least, math.ceil(total / batch_bytes))
    # Bounds of the batches: at most as many numbers as there are batches.
    cuts = docs.agg(F.percentile_approx("doc", [i / batches for i in range(1, batches)], 100_000)).first()[0] if batches > 1 else []
    cuts = sorted(set(cuts or []))
    family = Family(spark)
    for i in range(len(cuts) + 1):
        part = docs
        if i:
            part = part.where(F.col("doc") > cuts[i - 1])
        if i < len(cuts):
            part = part.where(F.col("doc") <= cuts[i])
        family.add(part, keep=i < len(cuts))
    contested = family.rows(CONTESTED)
    shared = spark.sparkContext.broadcast(place_filter(contested))
    partial = settle(contested_runs(docs, shared), contested.groupBy("key").count())
    return family.rows(FULL).select("doc", "start", "n").unionByName(partial)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES, least: int = BATCHES) -> DataFrame:
    """id, kept (the remaining bytes) and spans (removed byte ranges) of every row."""
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-2**63)).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    packed = (repeated_spans(docs, batch_bytes, least)
              .groupBy("doc").agg(F.collect_list(F.col("start") * 128 + F.col("n")).alias("runs")))
    joined = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(-2**63)).alias("doc")).join(packed, "doc", "left").drop("doc")

    def run(batch):
        ids, texts, lists = batch.column(0), batch.column(1), batch.column(2)
        kept, spans = [], []
        buf, offs = tb.string_buffers(texts)
        for i in range(len(texts)):
            text = buf[offs[i]:offs[i + 1]]
            if not lists[i].is_valid:
                kept.append(text.tobytes())
                spans.append([])
                continue
            packed = lists[i].values.to_numpy(zero_copy_only=False)
            a = packed >> 7
            b = a + (packed & 127) - 1 + SPAN
            fits = b <= len(text)
            step = np.bincount(a[fits], minlength=len(text) + 1) - np.bincount(b[fits], minlength=len(text) + 1)
            gone = np.cumsum(step[:-1]) > 0
            edge = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0]))))
            kept.append(text[~gone].tobytes())
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])])
        return {id_col: ids, "n_bytes": pa.array(np.diff(offs)), "kept": pa.array(kept, pa.binary()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))}

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    return tb.map_arrow(joined, run, [df.schema[id_col], T.StructField("n_bytes", T.LongType()), T.StructField("kept", T.BinaryType()),
                                      T.StructField("spans", T.ArrayType(span))])
