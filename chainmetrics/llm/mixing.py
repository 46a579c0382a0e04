"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets: sources share the words of the mix by weight, each at most ``most`` times its own words;
what is above goes to the others by weight (the level that all of them reach is found from the
sources sorted by size over weight).

Blocks: the documents of a source stand in a fixed order (by hash), end to end, and are cut into
blocks of ``block_words`` words. A source's quota is so many whole passes over its blocks and part
of one more; the last block drawn is cut, so that a source gives its target exactly, to the word.

Tree: a node has the block quotas of some consecutive shards. It hands its left half as many
blocks as these shards hold, in a multivariate hypergeometric draw (source by source, without
replacement), and the right half the rest; at the leaves stand every shard's blocks per
source, which add up to the quotas. The draws are inverted from hashed numbers with the exact
probabilities within twelve standard deviations, for quotas of any size.

Drawing: shards take disjoint runs of a source's draws, and the n-th draw is the block that a
keyed permutation (Feistel rounds, walked until in range) gives for n; a second
permutation per shard shuffles its blocks. Both are row-local: a document's blocks follow from its place alone.

Plan: one pass counts words and keeps a narrow table (checkpointed); a document's place is the sum
before it in its (source, hash bucket), which are windows over small groups, plus the
buckets before. No source is brought into one task, however large. The tree works on one row
per source. Everything follows from keys, texts and the seed, so reruns and other partitionings agree.

Defined results: null text has no words; null sources are one source, the last; documents of no
words are taken 0 times; rows of equal key and text are separate documents; a null key is
one more key; very long texts are spread over many blocks; sources of few words have one short
block; an empty table gives an empty table; columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chainmetrics.llm import textbuf as tb
from chainmetrics.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
#: Documents of a source are ordered in 2**BUCKET_BITS ranges of their hash.
BUCKET_BITS = 12
ROUNDS = 6
PIECES = "array<struct<shard: int, position: bigint, at: bigint, pass: int, first: bigint, words: bigint>>"


def _key(*numbers: int) -> np.ndarray:
    h = np.zeros(1, tb.U64)
    for n in numbers:
        h = tb.mix(h * tb.U64(tb.HASH_BASE) + tb.U64(n & (2**64 - 1)) + tb.U64(1))
    return h[0]


def permuted(x: np.ndarray, size: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Keyed permutation of range(size), element by element (each has its own size and key)."""
    size, keys = size.astype(tb.U64), keys.astype(tb.U64)
    bits = np.ceil(np.log2(np.maximum(size, 2).astype(np.float64)) / 2 + 1e-9).astype(tb.U64)
    mask = (tb.U64(1) << bits) - tb.U64(1)
    out, todo = x.astype(tb.U64), np.arange(len(x))
    while len(todo):
        b, m, k = bits[todo], mask[todo], keys[todo]
        left, right = out[todo] >> b, out[todo] & m
        for r in range(ROUNDS):
            left, right = right, left ^ (tb.mix(right + k * tb.U64(2 * r + 1)) & m)
        out[todo] = (left << b) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def hypergeometric(u: float, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` without replacement are good: the quantile at ``u``."""
    low, high = max(0, draws - bad), min(good, draws)
    total = good + bad
    if low == high:
        return low
    mean = draws * (good / total)
    spread = (mean * (bad / total) * ((total - draws) / max(1, total - 1))) ** 0.5
    first = max(low, int(mean - 12 * spread) - 2)
    last = min(high, int(mean + 12 * spread) + 2)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log((good - k) * (draws - k)) - np.log((k + 1) * (bad - draws + k + 1))
    chance = np.concatenate(([0.0], np.cumsum(steps)))
    chance = np.cumsum(np.exp(chance - chance.max()))
    return first + int(min(np.searchsorted(chance, u * chance[-1], "right"), len(chance) - 1))


def split_quotas(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (row) in each shard (column): rows sum to the quotas, and columns
    differ by one at most."""
    total = sum(quotas)
    bounds = [total * k // shards for k in range(shards + 1)]
    out = np.zeros((len(quotas), shards), np.int64)

    def descend(lo: int, hi: int, have: list[int]) -> None:
        if hi - lo == 1:
            out[:, lo] = have
            return
        mid = (lo + hi) // 2
        draws, rest = bounds[mid] - bounds[lo], bounds[hi] - bounds[lo]
        left = []
        for s, n in enumerate(have):
            rest -= n
            u = float(_key(seed, 1, lo, hi, s) >> tb.U64(11)) / 2.0**53
            left.append(hypergeometric(u, n, rest, draws))
            draws -= left[-1]
        descend(lo, mid, left)
        descend(mid, hi, [n - x for n, x in zip(have, left)])

    descend(0, shards, list(quotas))
    return out


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.0, most: int = 3) -> DataFrame:
    """Append rank, weight and target to one row per source (``source`` key and its ``source_size``).

    Weights go round in the order of the keys. One row per source: the windows are over that table."""
    everything = Window.partitionBy(F.lit(0))
    cap = F.col("source_size") * F.lit(float(most))
    ranked = (sources.withColumn("rank", F.row_number().over(everything.orderBy("source")) - 1)
              .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("rank") % len(weights) + 1)))
    order = everything.orderBy(cap / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.sum("source_size").over(everything) * F.lit(float(share))
    level = ((wanted - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
             / F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    # The first source that stays below its cap at its level sets the level of all after it.
    levels = ranked.withColumn("_level", level).withColumn("_place", F.row_number().over(order))
    below = F.col("_level") * F.col("weight") <= cap
    levels = levels.withColumn("_level", F.min_by(F.when(below, F.col("_level")), F.when(below, F.col("_place"))).over(everything))
    return levels.withColumn("target", F.coalesce(F.least(cap, F.col("_level") * F.col("weight")), cap)).drop("_level", "_place")


def _plan(batches: Iterator[pa.RecordBatch], shards: int, block_words: int, most: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Quotas of all sources, split over the shards: one row per source."""
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["rank"])
    if not rows:
        return
    size = np.array([r["source_size"] for r in rows], np.int64)
    give = np.minimum(most * size, np.floor(np.array([r["target"] for r in rows]) + 0.5).astype(np.int64))
    passes = give // np.maximum(size, 1)
    rest = give - passes * size
    blocks = -(-size // block_words)
    short = blocks * block_words - size  # words that the last block lacks
    keys = np.array([_key(seed, 2, r["rank"]) for r in rows], tb.U64)
    place = np.where(blocks > 0, permuted(np.maximum(blocks - 1, 0), np.maximum(blocks, 1), keys), 0)
    part = -(-rest // block_words)
    holds = lambda q: q * block_words - np.where(place < q, short, 0)
    part += holds(part) < rest
    cut = holds(part) - rest
    quotas = passes * blocks + part
    dealt = split_quotas(quotas.tolist(), shards, seed)
    starts = np.concatenate((np.zeros((len(rows), 1), np.int64), np.cumsum(dealt, axis=1)), axis=1)
    offsets = np.cumsum(dealt, axis=0) - dealt
    yield pa.RecordBatch.from_arrays(
        [pa.array([r["source"] for r in rows], pa.string())]
        + [pa.array(x, pa.int64()) for x in (size, [r["rank"] for r in rows], blocks, passes, part, cut)]
        + [pa.array([r["target"] for r in rows], pa.float64())]
        + [pa.array(list(x), pa.list_(pa.int64())) for x in (starts, offsets)]
        + [pa.array([dealt.sum(axis=0).tolist()] * len(rows), pa.list_(pa.int64()))],
        ["source", "source_size", "rank", "blocks", "passes", "part", "cut", "target", "starts", "offsets", "held"])


_PLAN = ("source string, source_size long, rank long, blocks long, passes long, part long, cut long, target double, "
         "starts array<long>, offsets array<long>, held array<long>")


def _lists(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def draw_pieces(batch: pa.RecordBatch, block_words: int, seed: int) -> pa.Array:
    """The pieces of each document that the mix takes, by shard and place in it.

    Reads columns place, size and those of the plan."""
    col = lambda name: batch.column(batch.schema.get_field_index(name)).to_numpy()
    place, size, ranks, blocks, passes, part, cut = (col(c) for c in ("place", "size", "rank", "blocks", "passes", "part", "cut"))
    first_block = place // block_words
    n_blocks = np.where(size > 0, (place + size - 1) // block_words - first_block + 1, 0)
    doc = np.repeat(np.arange(len(size)), n_blocks)
    block = tb.ragged(first_block, n_blocks)
    some, inverse = np.unique(ranks, return_inverse=True)
    keys = np.array([_key(seed, 2, int(r)) for r in some], tb.U64)[inverse] if len(some) else np.zeros(0, tb.U64)
    order = permuted(block, blocks[doc], keys[doc])
    times = passes[doc] + (order < part[doc])
    turn = tb.ragged(np.zeros_like(times), times)
    doc, block, order = (np.repeat(x, times) for x in (doc, block, order))
    start = np.maximum(block * block_words, place[doc])
    trimmed = np.where((turn == passes[doc]) & (order == part[doc] - 1), cut[doc], 0)
    # Cut words come off the block's end; the source's last block may end early.
    block_end = np.minimum((block + 1) * block_words, col("source_size")[doc]) - trimmed
    words = np.minimum(block_end, (place + size)[doc]) - start
    keep = words > 0
    doc, block, order, turn, start, words = (x[keep] for x in (doc, block, order, turn, start, words))

    draw = turn * blocks[doc] + order
    starts, offsets, held = (_lists(batch.column(batch.schema.get_field_index(c))) for c in ("starts", "offsets", "held"))
    shard = np.zeros(len(doc), np.int64)
    for s in range(len(some)):
        of = np.flatnonzero(inverse[doc] == s)
        if len(of):
            shard[of] = np.searchsorted(starts[doc[of[0]]], draw[of], "right") - 1
    slot = offsets[doc, shard] + draw - starts[doc, shard]
    shard_keys = np.array([_key(seed, 3, k) for k in range(offsets.shape[1])] or [0], tb.U64)
    position = permuted(slot, held[doc, shard], shard_keys[shard])
    bounds = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(size)))))
    struct = pa.StructArray.from_arrays(
        [pa.array(shard, pa.int32()), pa.array(position, pa.int64()), pa.array(start - block * block_words, pa.int64()),
         pa.array(turn, pa.int32()), pa.array(start - place[doc], pa.int64()), pa.array(words, pa.int64())],
        ["shard", "position", "at", "pass", "first", "words"])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), struct)


def mix(df: DataFrame, key_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = WEIGHTS,
        share: float = 1.0, most: int = 3, shards: int = 24, block_words: int = 512, seed: int = 7, keep_text: bool = False) -> DataFrame:
    """One row per document: its key, size (words), source_size, target (both of its source) and
    pieces (shard, position of the block in the shard, at: place in the block, pass, first
    word, words); ``keep_text`` carries the text along (null counts as empty).

    The mix has ``share`` of all words; a source gives at most ``most`` times its own."""
    if min(weights) <= 0 or shards < 1 or block_words < 1:
        raise ValueError("positive weights, and at least one shard and one word a block")
    tb.bounded_batches(df.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.xxhash64(text, F.lit(seed))
    # The key of a source sorts by code point, null last.
    source = F.when(F.col(source_col).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(source_col).cast("string")))
    narrow = materialize(df.select(
        F.col(key_col).alias("id"), source.alias("source"), F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
        F.xxhash64(F.col(key_col), digest).alias("h"), digest.alias("t"), *[text.alias("text")] * keep_text)
        .withColumn("bucket", F.shiftrightunsigned("h", 64 - BUCKET_BITS).cast("int")))
    buckets = materialize(narrow.groupBy("source", "bucket").agg(F.sum("size").alias("n")))
    sources = targets(buckets.groupBy("source").agg(F.sum("n").alias("source_size")), weights, share, most)
    # One row per source.
    plan = materialize(sources.select("source", "source_size", "rank", "target").repartition(1)
                       .mapInArrow(lambda batches: _plan(batches, shards, block_words, most, seed), _PLAN))
    until = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = buckets.select("source", "bucket", F.coalesce(F.sum("n").over(until), F.lit(0)).alias("bucket_first"))
    within = Window.partitionBy("source", "bucket").orderBy("h", "id", "t").rowsBetween(Window.unboundedPreceding, -1)
    placed = (narrow.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
              .join(firsts, ["source", "bucket"]).withColumn("place", F.col("before") + F.col("bucket_first"))
              .join(plan, "source"))
    out = ["id", "size", "source_size", "target", *["text"] * keep_text]
    given = placed.select(*out, "place", *[c for c in ("rank", "blocks", "passes", "part", "cut", "starts", "offsets", "held")])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:len(out)])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(out)], draw_pieces(batch, block_words, seed)], [*out, "pieces"])

    return given.mapInArrow(run, f"{schema}, pieces {PIECES}").withColumnRenamed("id", key_col)


def mixed_texts(df: DataFrame, key_col: str = "doc_id", **options) -> DataFrame:
    """The mix itself: shard, position, at, key and the piece's text, in the order of the shards.

    A piece reaches from its first word to the one after its last, or the text's end."""
    rows = mix(df, key_col=key_col, keep_text=True, **options).select(key_col, "text", "pieces")
    kind = rows.schema[key_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            buf, offs = tb.string_buffers(batch.column(1))
            starts, _, words = tb.word_spans(buf, offs, tb.NONSPACE)
            starts, raw = np.append(starts, len(buf)), buf.tobytes()
            pieces = batch.column(2)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(pieces.offsets.to_numpy()))
            flat = pieces.flatten()
            first, n = (flat.field(f).to_numpy() for f in ("first", "words"))
            begin = np.where(first == 0, offs[doc], starts[words[doc] + first])
            end = np.where(words[doc] + first + n >= words[doc + 1], offs[doc + 1], starts[np.minimum(words[doc] + first + n, len(starts) - 1)])
            texts = pa.array([raw[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([flat.field("shard"), flat.field("position"), flat.field("at"), batch.column(0).take(pa.array(doc)), texts],
                                             ["shard", "position", "at", "id", "text"])

    out = rows.mapInArrow(run, f"shard int, position long, at long, id {kind}, text string")
    # Ranges of (shard, position): a shard larger than a task's share is written by several.
    return out.repartitionByRange("shard", "position").sortWithinPartitions("shard", "position", "at").withColumnRenamed("id", key_col)
