"""Phrase collocations by the stripes pattern.

Texts (A-Z folded) are cut into pieces at punctuation and line ends, pieces into words. Every
word occurrence is a prefix that counts what follows it in its piece: one *stripe* per
prefix, an associative counter from (next word, word after it) to occurrences, either of
which may be the end of the piece. One merged stripe of w1 has all that mining asks for:
its total is f(w1), the sum over (w2, *) is f(w1 w2), the entry (w2, w3) is f(w1 w2 w3), and the
largest entry (w2, w3) is the best longer phrase that begins with w1 w2.

Plan: texts are combined into stripes inside a task (a few megabytes of text at a time),
stripes are shuffled by their prefix and merged element by element, streamed in key
order; only phrases of the least count leave the merge. Then come joins of frequent
phrases only, and a top list per group, cut to its length in every task before the shuffle.

Frequent prefixes: a first pass counts all words (folded per task, then one aggregation). A prefix
beyond a segment's share of all words has several segments; an entry's segment follows
from its two next words, so that neither one prefix nor one pair of words gathers in one
task. Only the hashes of such prefixes are broadcast: by the share, at most ``SEGMENTS``.
The sums of segments are put together by partial aggregation.

Arithmetic is exact: counts are 64-bit, products 38-digit decimals.

Defined results: null text is empty, null language is ``und``; words may hold any other
characters and be of any length; very long texts are counted whole (they are cut where a
piece ends, and nothing crosses pieces); equal ranks are settled by count, then by the
phrase's bytes; repeated rows count each time; an empty table or one without words
gives no rows; columns other than text and group are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chainmetrics.llm import textbuf as tb
from chainmetrics.session import materialize

#: Bytes of text that are combined before stripes are handed on.
COMBINE_BYTES = 4 << 20
#: A prefix is segmented beyond the larger of so many words and a share of 1/SEGMENTS of all words.
SEGMENT_WORDS = 20_000
SEGMENTS = 50_000
#: Merged at a time, in bytes of entries.
MERGE_BYTES = 4 << 20
#: A group's phrases are ranked in so many portions, then those that are left together.
PORTIONS = 16
#: Segment of a prefix that has one only.
SINGLE = -1

BREAK = tb.byte_class(lambda b: chr(b) in ".,;:!?" or 10 <= b <= 13)
WORD = tb.byte_class(lambda b: b not in (32, 9)) & ~BREAK


def word_table(buf: np.ndarray, offs: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """(words in order, row of each, whether the next word follows in the same piece)."""
    buf = tb.LOWER[buf]
    starts, ends, first = tb.word_spans(buf, offs, WORD)
    n = len(starts)
    ends_at = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    # The words are all the word bytes, one after the other.
    words = pa.StringArray.from_buffers(n, pa.py_buffer(ends_at), pa.py_buffer(buf[WORD[buf]])).dictionary_encode()
    rows = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    piece = np.cumsum(BREAK[buf], dtype=np.int64)[starts] if n else np.zeros(0, np.int64)
    follows = np.zeros(n, bool)
    follows[:-1] = (piece[1:] == piece[:-1]) & (rows[1:] == rows[:-1])
    return words, rows, follows


def _hashes(words: pa.StringArray) -> np.ndarray:
    buf, offs = tb.string_buffers(words)
    return tb.span_hashes(buf, offs[:-1], offs[1:])


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(groups, bytes, offsets) of about ``COMBINE_BYTES`` each; longer texts are cut after a break."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(1).nbytes
            if size >= COMBINE_BYTES:
                yield from _cut(held)
                held, size = [], 0
    if held:
        yield from _cut(held)


def _cut(held: list[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    groups = pa.concat_arrays([b.column(0) for b in held])
    buf, offs = tb.string_buffers(pa.concat_arrays([b.column(1).cast(pa.large_string()) for b in held]))
    for lo, hi, b, o in tb.slices(buf, offs, COMBINE_BYTES):
        if len(b) <= COMBINE_BYTES:
            yield groups[lo:hi], b, o
            continue
        at, breaks = 0, np.flatnonzero(BREAK[b]) + 1
        while at < len(b):  # one text; a piece longer than a portion stays whole
            k = int(np.searchsorted(breaks, at + COMBINE_BYTES, "right"))
            end = breaks[k - 1] if k and breaks[k - 1] > at else breaks[k] if k < len(breaks) else len(b)
            end = len(b) if len(b) - at <= COMBINE_BYTES else int(end)
            yield groups[lo:hi], b[at:end], np.array([0, end - at])
            at = end


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, hash of word, occurrences) of every portion."""
    for groups, buf, offs in _portions(batches):
        words, rows, _ = word_table(buf, offs)
        if not len(words):
            continue
        group = groups.dictionary_encode()
        size = len(words.dictionary)
        code, n = np.unique(group.indices.to_numpy()[rows].astype(np.int64) * size + words.indices.to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([
            group.dictionary.take(pa.array(code // size)), pa.array(_hashes(words.dictionary)[code % size].view(np.int64)),
            pa.array(n, pa.int64())], ["grp", "word", "n"])


def stripes(batches: Iterator[pa.RecordBatch], hot: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Stripes of every portion: group, prefix, segment, entries ("w2 w3" lines, an end being
    empty) and their counts. ``hot``: sorted hashes of segmented prefixes, and their segments."""
    for groups, buf, offs in _portions(batches):
        words, rows, follows = word_table(buf, offs)
        if not len(words):
            continue
        group = groups.dictionary_encode()
        end = len(words.dictionary)
        base = end + 1
        one = words.indices.to_numpy().astype(np.int64)
        two, three = np.full(len(one), end), np.full(len(one), end)
        two[:-1] = np.where(follows[:-1], one[1:], end)
        three[:-1] = np.where(follows[:-1], two[1:], end)
        pairs, pair = np.unique((group.indices.to_numpy()[rows].astype(np.int64) * base + one) * base + two, return_inverse=True)
        entry, counts = np.unique(pair * base + three, return_counts=True)
        three, two = entry % base, pairs[entry // base]
        two, one, which = two % base, two // base % base, two // base // base

        hashes = np.append(_hashes(words.dictionary), tb.U64(0))
        segments = np.ones(base, np.uint64)
        if len(hot[0]):
            at = np.minimum(np.searchsorted(hot[0], hashes[:-1]), len(hot[0]) - 1)
            segments[:-1] = np.where(hot[0][at] == hashes[:-1], hot[1][at], 1)
        s1, s2 = segments[one], segments[two]
        # A frequent pair has two frequent words, so its entries spread over segments, too.
        segment = ((hashes[two] + hashes[three] % s2) % s1).astype(np.int64)
        segment = np.where(s1 == 1, SINGLE, 2 * segment + (s2 == 1))  # odd: sums of pairs are complete
        if (s1 > 1).any():
            order = np.lexsort((segment, one, which))
            which, one, two, three, segment, counts = (x[order] for x in (which, one, two, three, segment, counts))
        first = np.flatnonzero(np.concatenate(([True], (np.diff(which) != 0) | (np.diff(one) != 0) | (np.diff(segment) != 0))))
        names = pa.concat_arrays([words.dictionary, pa.array([""])])
        lines = pc.binary_join_element_wise(names.take(pa.array(two)), names.take(pa.array(three)), " ")
        bounds = np.append(first, len(one))
        yield pa.RecordBatch.from_arrays([
            group.dictionary.take(pa.array(which[first])), names.take(pa.array(one[first])), pa.array(segment[first], pa.int32()),
            pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), lines), "\n"),
            pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(counts.astype("<u4"))]),
        ], ["grp", "w1", "segment", "entries", "counts"])


def _sums(codes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order by code, first of each code in that order, codes, sums)."""
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return order, first, codes[first], np.add.reduceat(values[order], first)


def merge(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Merge stripes that arrive in key order, and give the sums that mining needs.

    Rows: (group, w1, w2, w3, n, longer). w2 and w3 null: a (part of a) prefix total; w3 null: a
    (part of a) pair's sum with its largest extension; else a phrase of three words."""
    carried = None  # key, entries, counts of the last prefix, merged so far

    def combined(held, last):
        nonlocal carried
        keys = [pa.concat_arrays([b.column(i) for b in held]) for i in range(3)]
        lines = pc.split_pattern(pa.concat_arrays([b.column(3) for b in held]), "\n")
        sizes = np.diff(lines.offsets.to_numpy())
        entries = lines.flatten()
        counts = np.concatenate([_u4(b.column(4)) for b in held]).astype(np.int64)
        change = np.zeros(len(sizes), bool)
        for k in keys:
            change[1:] |= pc.not_equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False)
        if carried is not None:
            key, old, old_counts = carried
            change[0] = key != tuple(k[0].as_py() for k in keys)
            keys = [pa.concat_arrays([pa.array([v], k.type), k]) for v, k in zip(key, keys)]
            entries, counts = pa.concat_arrays([old, entries]), np.concatenate((old_counts, counts))
            sizes, change = np.append(len(old), sizes), np.append(False, change)
        prefix = np.cumsum(change)
        heads = np.flatnonzero(np.append(True, change[1:]))
        entries = entries.dictionary_encode()
        lines = entries.dictionary
        _, _, code, n = _sums(np.repeat(prefix, sizes) * len(lines) + entries.indices.to_numpy(), counts)
        prefix, line = code // len(lines), code % len(lines)
        keys = [k.take(pa.array(heads)) for k in keys]
        carried = None
        if not last:
            kept = int(np.searchsorted(prefix, len(heads) - 1))
            carried = tuple(k[-1].as_py() for k in keys), lines.take(pa.array(line[kept:])), n[kept:]
            prefix, line, n = prefix[:kept], line[:kept], n[:kept]
        if not len(prefix):
            return None
        return _found(keys, prefix, line, n, lines, least)

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(3).nbytes
            if size >= MERGE_BYTES:
                if (out := combined(held, False)) is not None:
                    yield out
                held, size = [], 0
    if held:
        yield combined(held, True)
    elif carried is not None:
        key, lines, n = carried
        keys = [pa.array([v], t) for v, t in zip(key, (pa.string(), pa.string(), pa.int32()))]
        yield _found(keys, np.zeros(len(n), np.int64), np.arange(len(n)), n, lines, least)


def _u4(column: pa.BinaryArray) -> np.ndarray:
    offs = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    return np.frombuffer(column.buffers()[2], np.uint8)[offs[0]:offs[-1]].copy().view("<u4")


def _found(keys: list, prefix: np.ndarray, line: np.ndarray, n: np.ndarray, lines: pa.StringArray, least: int) -> pa.RecordBatch:
    both = pc.split_pattern(lines, " ").flatten()
    second, third = both.take(pa.array(np.arange(0, len(both), 2))), both.take(pa.array(np.arange(1, len(both), 2)))
    is_end2, is_end3 = (pc.equal(x, "").to_numpy(zero_copy_only=False) for x in (second, third))
    segment = keys[2].to_numpy()
    second = second.dictionary_encode()
    two = second.indices.to_numpy()

    # Totals of prefixes: complete for prefixes of one segment.
    first = np.flatnonzero(np.concatenate(([True], np.diff(prefix) != 0)))
    total, owner = np.add.reduceat(n, first), prefix[first]
    keep = (total >= least) | (segment[owner] != SINGLE)
    out = [(owner[keep], None, None, total[keep], np.zeros(int(keep.sum()), np.int64))]

    # Pairs, with their largest extension.
    order, first, code, pair = _sums(prefix * len(second.dictionary) + two[line], n)
    longer = np.maximum.reduceat(np.where(is_end3[line], 0, n)[order], first)
    sample = line[order][first]
    owner = code // len(second.dictionary)
    part = (segment[owner] != SINGLE) & (segment[owner] % 2 == 0)
    keep = ~is_end2[sample] & ((pair >= least) | part)
    out.append((owner[keep], second.dictionary.take(pa.array(code[keep] % len(second.dictionary))), None, pair[keep], longer[keep]))

    keep = ~is_end3[line] & (n >= least)
    out.append((prefix[keep], second.dictionary.take(pa.array(two[line[keep]])), third.take(pa.array(line[keep])), n[keep], np.zeros(int(keep.sum()), np.int64)))
    columns = []
    for rows, w2, w3, count, longest in out:
        rows = pa.array(rows)
        nothing = pa.nulls(len(rows), pa.string())
        columns.append([keys[0].take(rows), keys[1].take(rows), nothing if w2 is None else w2, nothing if w3 is None else w3,
                        pa.array(count, pa.int64()), pa.array(longest, pa.int64())])
    return pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*columns)], ["grp", "w1", "w2", "w3", "n", "longer"])


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1,000,000 a a / (left right)), exactly; at most 1,000,000, as a is in either part."""
    d = lambda c: c.cast("decimal(19,0)")
    num = F.lit(1_000_000).cast("decimal(38,0)") * (d(a) * d(a))
    return F.call_function("div", num, d(left) * d(right)).cast("long")


def mine(df: DataFrame, text_col: str = "text", group_col: str = "lang", least: int = 10, share: int = 50, top: int = 2000,
         segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Collocations of two or three words of each group: ``group_col``, rank, phrase, a
    (occurrences), l and r (of the parts of the lowest-scoring cut), n (words of the group), score.

    A pair that mostly (``share`` %) stands inside one longer phrase of at least ``least``
    occurrences is left out."""
    spark = df.sparkSession
    tb.bounded_batches(spark)
    texts = df.select(F.coalesce(F.col(group_col).cast("string"), F.lit("und")).alias("grp"), F.col(text_col).alias("t"))

    counted = materialize(texts.mapInArrow(count_words, "grp string, word long, n long").groupBy("grp", "word").agg(F.sum("n").alias("n")))
    sizes = counted.groupBy("grp").agg(F.sum("n").alias("n"))
    segment = max(segment_words, (counted.agg(F.sum("n")).first()[0] or 0) // SEGMENTS)
    # A share of 1/SEGMENTS of all words: at most SEGMENTS rows.
    frequent = (counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") > segment)
                .select("word", (F.floor(F.col("n") / segment) + 1).alias("s")).toPandas().to_numpy(np.int64).reshape(-1, 2))
    hashes = frequent[:, 0].astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    hot = spark.sparkContext.broadcast((hashes[order], frequent[order, 1].astype(np.uint64)))

    made = texts.mapInArrow(lambda batches: stripes(batches, hot.value), "grp string, w1 string, segment int, entries string, counts binary")
    key = ("grp", "w1", "segment")
    merged = materialize(made.repartition(*key).sortWithinPartitions(*key)
                         .mapInArrow(lambda batches: merge(batches, least), "grp string, w1 string, w2 string, w3 string, n long, longer long"))

    ones = (merged.where("w2 is null").groupBy("grp", "w1").agg(F.sum("n").alias("n")).where(F.col("n") >= least))
    twos = materialize(merged.where("w2 is not null and w3 is null").groupBy("grp", "w1", "w2")
                       .agg(F.sum("n").alias("a"), F.max("longer").alias("longer")).where(F.col("a") >= least))
    threes = merged.where("w3 is not null").select("grp", "w1", "w2", "w3", F.col("n").alias("a"))

    def ones_as(word, name):
        return ones.select("grp", F.col("w1").alias(word), F.col("n").alias(name))

    def twos_as(first, second, name):
        return twos.select("grp", F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(name))

    before = threes.groupBy("grp", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("a").alias("before"))
    longest = F.greatest(F.when(F.col("longer") >= least, F.col("longer")).otherwise(0), F.coalesce("before", F.lit(0)))
    pairs = (twos.join(before, ["grp", "w1", "w2"], "left").where(100 * longest < share * F.col("a"))
             .join(ones_as("w1", "l"), ["grp", "w1"]).join(ones_as("w2", "r"), ["grp", "w2"])
             .select("grp", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score")))
    cut = (threes.join(twos_as("w1", "w2", "l2"), ["grp", "w1", "w2"]).join(twos_as("w2", "w3", "r1"), ["grp", "w2", "w3"])
           .join(ones_as("w1", "l1"), ["grp", "w1"]).join(ones_as("w3", "r2"), ["grp", "w3"])
           .withColumn("s1", _score(F.col("a"), F.col("l1"), F.col("r1"))).withColumn("s2", _score(F.col("a"), F.col("l2"), F.col("r2"))))
    early = F.col("s1") <= F.col("s2")
    triples = cut.select("grp", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"),
                         F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    best = pairs.unionByName(triples)
    # The best of each portion first, so that one group's task sees at most PORTIONS * top rows.
    for by in (["grp", F.pmod(F.xxhash64("phrase"), F.lit(PORTIONS))], ["grp"]):
        ranked = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), "phrase")
        best = best.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return best.join(sizes, "grp").select(F.col("grp").alias(group_col), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
