"""Near-duplicate groups by SetSketch registers.

A text's set is its distinct 5-word shingles (64-bit hashes). Its sketch is
``REGISTERS`` SetSketch registers: for each of as many hash functions the minimum over
the set, on an exponential scale of base ``BASE``, truncated to one byte. Registers of
a union are the maxima of the registers (``merge``), and the share of equal registers
falls with the distance of the sets.

1. One pass makes the sketches; texts with equal sets are grouped first, and each set
   goes on as one node, numbered on its own.
2. Bands of ``ROWS`` registers are bucket keys. Members of a bucket are linked to its
   smallest node only: a bucket of n members makes n - 1 candidates.
3. The joint likelihood of both sketches and the known set sizes estimates the similarity
   of a candidate; clear misses (``EST_MARGIN`` below the threshold, four standard
   errors) go.
4. The best candidate of each text is confirmed on full sets, twice; candidates that a
   confirmed link has put into one component need no confirmation. Components are found
   by large-star/small-star steps on DataFrames.
5. Buckets that still hold several components are compared across components: in blocks,
   by the sketches first, then on full sets. No partner is dropped because of a bucket's
   size, and only confirmed links leave a block.

Nothing about all documents reaches the driver but counts. Intermediate tables go to
the shared checkpoint folder.

With 36 bands of 7 registers a pair at similarity 0.85 shares no bucket with a
probability under 1e-6; the registers' scale only adds collisions to that.

Defined results: null, empty and wordless texts have no shingles, are linked with
nothing and kept; a text of one to four words is one shingle; very long texts are taken
whole, a slice of their own in one task; rows that share an id are one document, linked by
each of their texts, in whatever order they come; a null id is linked with nothing and kept; equal texts are linked; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmetrics.llm import textbuf as tb
from chainmetrics.session import materialize, scratch_path

SHINGLE = 5
REGISTERS = 256
BANDS, ROWS = 36, 7
BASE, RATE = 1.08, 20.0
EST_MARGIN = 0.10
#: Members of a bucket compared with one another in one group.
BLOCK = 512
#: Rounds in which each text's best candidate among its buckets' smallest ids is confirmed.
STAR_ROUNDS = 2

_rng = np.random.default_rng(85)
_XOR = _rng.integers(0, 2**32, (REGISTERS, 1), dtype=np.uint32)
_MUL = _rng.integers(0, 2**31, (REGISTERS, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of one text's word hashes."""
    if not len(words):
        return np.zeros(0, tb.U64)
    return np.unique(tb.gram_hashes(words, min(SHINGLE, len(words))))


def sketch(shingle_hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers (one byte each) of a non-empty set."""
    low = (shingle_hashes >> tb.U64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 2**32 - 1, np.uint32)
    for i in range(0, len(low), 1024):
        x = (low[None, i:i + 1024] ^ _XOR) * _MUL
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(1), out=least)
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, 255).astype(np.uint8)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of the union of two sets."""
    return np.maximum(a, b)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of sketch pairs (rows) given the set sizes."""
    if not len(a):
        return np.zeros(0)
    above, below = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - above - below
    n_a, n_b = np.asarray(n_a, float), np.asarray(n_b, float)
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    grid = np.linspace(0, 1, 101)

    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    # At the bound min(u/v, v/u) one set holds the other.
    j = grid[None, :] * np.minimum(u / v, v / u)[:, None]
    up, down = p(u[:, None] - v[:, None] * j), p(v[:, None] - u[:, None] * j)
    same = np.clip(1 - up - down, 1e-12, 1)
    like = above[:, None] * np.log(up) + below[:, None] * np.log(down) + equal[:, None] * np.log(same)
    return j[np.arange(len(j)), like.argmax(1)]


def text_shingles(buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    starts, ends, rows = tb.word_spans(buf, offs, tb.NONSPACE)
    words = tb.span_hashes(buf, starts, ends, tb.LOWER)
    return [shingles(words[i:j]) for i, j in zip(rows, rows[1:])]


def sketches(docs: DataFrame) -> DataFrame:
    """id, th, n (set size), digest (of the set), sketch; null digest and sketch for empty sets. ``docs``: id, text, th."""
    def run(batch):
        n, digest, out = [], [], []
        buf, offs = tb.string_buffers(batch.column(1))
        for _, _, b, o in tb.slices(buf, offs):
            for s in text_shingles(b, o):
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                out.append(sketch(s).tobytes() if len(s) else None)
        return {"id": batch.column(0), "th": batch.column(2), "n": pa.array(n, pa.int64()), "digest": pa.array(digest, pa.binary()), "sketch": pa.array(out, pa.binary())}

    return tb.map_arrow(docs, run, [T.StructField("id", T.LongType()), T.StructField("th", T.LongType()), T.StructField("n", T.LongType()),
                                    T.StructField("digest", T.BinaryType()), T.StructField("sketch", T.BinaryType())])


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def buckets(reps: DataFrame) -> DataFrame:
    """(id, band, key): one row for each band of each sketch."""
    band = [F.xxhash64(F.lit(i), F.substring("sketch", i * ROWS + 1, ROWS)) for i in range(BANDS)]
    return reps.select("id", F.posexplode(F.array(*band)).alias("band", "key"))


def similar(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """(a, b, est) of the candidate pairs whose estimate is not clearly below the threshold."""
    side = lambda x: reps.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")
    # Sets whose sizes differ too much can't be that similar.
    joined = joined.where((F.col("n_a") >= threshold * F.col("n_b")) & (F.col("n_b") >= threshold * F.col("n_a")))

    def run(batch):
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, REGISTERS) for c in (4, 5))
        est = estimate(a, b, batch.column(2).to_numpy(), batch.column(3).to_numpy())
        keep = pa.array(est >= threshold - EST_MARGIN)
        return {"a": batch.column(0).filter(keep), "b": batch.column(1).filter(keep), "est": pa.array(est).filter(keep)}

    return tb.map_arrow(joined, run, [T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("est", T.DoubleType())])


def linked(x: np.ndarray, y: np.ndarray, threshold: float) -> bool:
    """Whether two shingle sets reach the threshold, in whole numbers."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common > 0 and 100 * common >= round(100 * threshold) * (len(x) + len(y) - common)


def confirm(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of the pairs whose full sets reach the threshold. ``texts``: id, text."""
    side = lambda x: texts.select(F.col("id").alias(x), F.col("text").alias(f"t_{x}"))
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "t_a", "t_b")

    def run(batch):
        sets = []
        for c in (2, 3):
            buf, offs = tb.string_buffers(batch.column(c))
            sets.append([s for _, _, b, o in tb.slices(buf, offs) for s in text_shingles(b, o)])
        keep = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(*sets)):
            keep[i] = linked(x, y, threshold)
        keep = pa.array(keep)
        return {"a": batch.column(0).filter(keep), "b": batch.column(1).filter(keep)}

    return tb.map_arrow(joined, run, [T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def components(edges: DataFrame) -> DataFrame:
    """(id, comp): smallest id reachable from each id of the edges (a, b); large-star/small-star."""
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    size = now.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("u").cast("decimal(38,0)")), F.lit(0))).first()
    while True:
        # Large star: neighbours above a node are joined to the least of its neighbours and itself.
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).union(now.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).where("v <> u").distinct()
        # Small star: neighbours below a node and the node itself are joined to the least of them.
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (large.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u")
                 .union(low.select("v", F.col("m").alias("u"))).distinct())
        new = materialize(small)
        after = new.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("u").cast("decimal(38,0)")), F.lit(0))).first()
        if after == size and new.groupBy("v").count().where("count > 1").isEmpty() and new.select(F.col("u").alias("v")).join(new, "v", "left_semi").isEmpty():
            break
        now, size = new, after
    return new.select(F.col("v").alias("id"), F.col("u").alias("comp")).union(new.select(F.col("u").alias("id"), F.col("u").alias("comp")).distinct())


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Component labels (id, comp) after adding confirmed links (a, b); ids without a row are their own component."""
    return _stored(_labelled_union(labels, links), "neardup-labels")


def _labelled_union(labels: DataFrame, links: DataFrame) -> DataFrame:
    over = components(_crossing(links, labels).select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    over = over.select(F.col("id").alias("comp"), F.col("comp").alias("new"))
    moved = labels.join(over, "comp", "left").select("id", F.coalesce("new", "comp").alias("comp"))
    fresh = over.select(F.col("comp").alias("id"), F.col("new").alias("comp")).join(labels, "id", "left_anti")
    return moved.union(fresh)


def _crossing(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs between different components, with their labels ca and cb."""
    la, lb = labels.select(F.col("id").alias("a"), F.col("comp").alias("ca")), labels.select(F.col("id").alias("b"), F.col("comp").alias("cb"))
    return (pairs.join(la, "a", "left").join(lb, "b", "left")
            .withColumn("ca", F.coalesce("ca", "a")).withColumn("cb", F.coalesce("cb", "b")).where("ca <> cb"))


def _settle(pairs: DataFrame, labels: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Labels after ``STAR_ROUNDS`` rounds, each confirming the best open candidate of every text."""
    for _ in range(STAR_ROUNDS):
        open_ = _stored(_crossing(pairs, labels).select("a", "b", "est"), "neardup-open")
        best = (open_.groupBy("a").agg(F.max_by(F.struct("b", "est"), F.struct("est", "b")).alias("p"))
                .select("a", F.col("p.b").alias("b")))
        links = _stored(confirm(best, texts, threshold), "neardup-links")
        labels = _relabel(labels, links)
        pairs = open_.join(best, ["a", "b"], "left_anti")
    return labels


def _contested(reps: DataFrame, keyed: DataFrame, labels: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Confirmed links (a, b) between members of a bucket that lie in different components.

    A bucket is compared block by block: a member goes to as many groups as its bucket
    has blocks, and only links leave a group. A pair that shares several buckets is
    looked at in the first of them alone."""
    member = keyed.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    several = (member.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size"))
               .where("lo <> hi").select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    rows = (member.join(several, "key").join(reps.select("id", "n", "sketch"), "id").join(texts, "id")
            .withColumn("i", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
            .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", F.least("i", "j").alias("x"), F.greatest("i", "j").alias("y"), "i", "band", "id", "comp", "n", "sketch", "text"))
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(group: pa.Table) -> pa.Table:
        ids, comp, n, i = (group.column(c).to_numpy() for c in ("id", "comp", "n", "i"))
        regs = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(-1, REGISTERS)
        x, y, band = (group.column(c)[0].as_py() for c in ("x", "y", "band"))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for r in range(len(ids)):
            other = (comp != comp[r]) & ((ids < ids[r]) if x == y else (i != i[r]) & (i[r] == x))
            at = np.flatnonzero(other & (n >= threshold * n[r]) & (n[r] >= threshold * n))
            same = regs[at] == regs[r]
            # Registers of such sets are equal at least as often as elements are shared.
            good = same.sum(1) >= (threshold - 2.5 * EST_MARGIN) * REGISTERS
            good &= same[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS).all(2).argmax(1) == band
            at = at[good]
            if len(at):
                est = estimate(np.broadcast_to(regs[r], (len(at), REGISTERS)), regs[at], np.full(len(at), n[r]), n[at])
                good = est >= threshold - EST_MARGIN
                found.append((np.full(good.sum(), r), at[good], est[good]))
        a, b, est = map(np.concatenate, zip(*found))
        links, sets, root = [], {}, {c: c for c in comp.tolist()}

        def find(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        def shingle_set(k):
            if k not in sets:
                sets[k] = text_shingles(*tb.string_buffers(pa.array([group.column("text")[k].as_py()])))[0]
            return sets[k]

        for p in np.argsort(-est, kind="stable").tolist():
            r, q = int(a[p]), int(b[p])
            ca, cb = find(int(comp[r])), find(int(comp[q]))
            if ca != cb and linked(shingle_set(r), shingle_set(q), threshold):
                links.append((int(ids[r]), int(ids[q])))
                root[max(ca, cb)] = min(ca, cb)
        return pa.table({"a": pa.array([v for v, _ in links], pa.int64()), "b": pa.array([v for _, v in links], pa.int64())})

    return rows.groupBy("key", "x", "y").applyInArrow(run, schema)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.85) -> DataFrame:
    """id, n_shingles, component_id and kept (the row's id is its component's) for every row."""
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    # The hash tells rows of one id apart.
    docs = df.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("th"))
    base = _stored(sketches(docs), "neardup-sketches")
    sets = base.where("id is not null and digest is not null")
    # Equal sets first: one node each, whatever the number of copies, with the least row that has the set.
    reps = _stored(sets.groupBy("digest").agg(F.min(F.struct("id", "th")).alias("r"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
                   .select(F.monotonically_increasing_id().alias("id"), "digest", F.col("r.id").alias("doc"), F.col("r.th").alias("th"), "n", "sketch"),
                   "neardup-reps")
    nodes = reps.select("id", "n", "sketch")
    members = _stored(sets.join(reps.select("digest", F.col("id").alias("node")), "digest").select("id", "node"), "neardup-members")
    keyed = buckets(nodes)
    shared = keyed.groupBy("key").agg(F.min("id").alias("b"), F.count(F.lit(1)).alias("size")).where("size > 1")
    star = keyed.join(shared, "key").where("id <> b").select(F.col("id").alias("a"), "b").distinct()
    pairs = _stored(similar(star, nodes, threshold), "neardup-candidates")
    # Only texts that any candidate or contested bucket can need; equal rows have equal texts.
    some = keyed.join(shared.select("key"), "key").select("id").distinct()
    wanted = reps.join(some, "id", "left_semi").select(F.col("id").alias("node"), F.col("doc").alias("id"), "th")
    texts = _stored(docs.join(wanted, ["id", "th"]).dropDuplicates(["node"]).select(F.col("node").alias("id"), "text"), "neardup-texts")
    found = _settle(pairs, spark.createDataFrame([], "id long, comp long"), texts, threshold)
    links = _stored(_contested(nodes, keyed, found, texts, threshold), "neardup-links")
    # Rows of one id are one document, whatever their texts: that links their sets.
    several = members.groupBy("id").agg(F.min("node").alias("b"), F.max("node").alias("hi")).where("b < hi").select("id", "b")
    found = _relabel(found, links.unionByName(members.join(several, "id").where("node <> b").select(F.col("node").alias("a"), "b")))
    comp = reps.select("id", "doc").join(found, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    least = comp.groupBy("comp").agg(F.min("doc").alias("component_id"))
    final = (members.join(comp.join(least, "comp").select(F.col("id").alias("node"), "component_id"), "node")
             .groupBy("id").agg(F.min("component_id").alias("component_id")))
    return (base.select("id", "n").join(final, "id", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))
