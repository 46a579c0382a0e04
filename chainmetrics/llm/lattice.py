"""Language-model scores: the marginal probability of a text in a subword lattice.

The model writes a text as words (lower-cased A-Z, a blank before each) and an end. A word
is written as pieces of an existing byte-level vocabulary (every byte is one), each with a
probability, the end with its own; all of them together have mass 1. The score is the
log10 of the text's marginal over all segmentations. No piece reaches over a blank, so it
is the sum over the words of their own marginals, each by the forward recursion in log
space over the positions of the word, and the end's share.

The vocabulary's own scores (its ranks) are the prior of the piece probabilities; expected
counts over the segmentations of all training words, as often as they occur, refine them in
``ROUNDS`` rounds over the whole corpus, the next with the weights of the last. Piece
totals, at most one number per piece of the vocabulary, are what reaches the driver, so
scores don't depend on how the table is dealt out.

``base_score`` is the smoothed count of words alone, ``mixed_score`` mixes both:

    P(word) = (c + V * L(word)) / (N + V + 1)      P(end) = (c(end) + 1) / (N + V + 1)

with c, N, V the token counts of the training texts (V is 1 at least) and L the word's
marginal: new words have the weight of as many tokens as there are distinct ones.

Plan: the table is dealt with in blocks of about ``BLOCK_BYTES`` of text. Each block
sends one row per distinct word (hash, block, training count, bytes of training words),
never per token; a window over the word sums them, which spreads a frequent word as one
row per block, and the first of them keeps the bytes; each round passes over those;
the sums go back to their blocks, where a cogroup with the texts scores them. The word
sums are kept as a table in the shared checkpoint folder.

Very long words (``LONG`` bytes and more) are cut in segments, all of them walked at once:
the recursion is linear in its last values, so each segment first gives the map from the
values before it to those at its end, the maps give the values at all cuts, and from there
all segments are filled. Nothing is cut off; time stays linear in the word's length.

Defined results: null text is the empty text (one token, the end); without training
texts every count is 0 and the prior alone weighs the pieces; repeated rows count each time;
an empty table gives an empty table; other input columns are ignored; texts of any length are
scored whole.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from chainmetrics.llm import textbuf as tb
from chainmetrics.llm.bpe import byte_alphabet
from chainmetrics.session import scratch_path

BLOCK_BYTES = 8 << 20
#: Pieces beyond this many bytes are looked up only where their first bytes stand.
COMMON_BYTES = 16
#: Rounds of expected counts over all distinct training words.
ROUNDS = 2
#: Weight of the prior: the expected count of all pieces together before any text.
PRIOR = 1000.0
CHUNK = 4096
#: Longest word whose expected counts are summed without logarithms.
PLAIN = 32
#: Words from this length on are walked in segments, this many bytes of them at once.
LONG = 2048
SEGMENT = 256
STRETCH = 1 << 16
LN10 = np.log(10.0)


def vocabulary_pieces(tokenizer: str) -> list[bytes]:
    """Pieces of a byte-level tokenizer file in rank order that can occur in a lower-cased word."""
    with open(tokenizer, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    alphabet, out = byte_alphabet(), []
    for token in sorted(vocab, key=vocab.get):
        if all(c in alphabet for c in token):
            piece = bytes(alphabet[c] for c in token)
            inner = piece[1:] if piece[0] == 32 else piece
            if all(tb.NONSPACE[b] and not 65 <= b <= 90 for b in inner):
                out.append(piece)
    return out


def prior_weights(n: int) -> np.ndarray:
    """Existing scores as probabilities: falling with the rank in the vocabulary."""
    w = 1 / (np.arange(n) + 10.0)
    return w / w.sum()


def _hash(piece: bytes) -> int:
    h = 0
    for b in piece:
        h = (h * tb.HASH_BASE + b + 1) & (2**64 - 1)
    return h


def _sum(x: np.ndarray) -> np.ndarray:
    """log of the sum of exponentials along the first axis; minus infinity where all are."""
    top = x.max(0)
    top[np.isneginf(top)] = 0
    x -= top
    np.exp(x, out=x)
    with np.errstate(divide="ignore"):
        return np.log(x.sum(0)) + top


def _steps(weights: list[tuple[int, np.ndarray]], last: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Walk on from the values ``last`` (nearest first): all new values and the last ones.

    ``weights``: piece length and log weights of the pieces ending at each step (first axis)."""
    values = []
    for s in range(len(weights[0][1])):
        values.append(_sum(np.array([last[l - 1] + w[s] for l, w in weights])))
        last = [values[-1], *last[:-1]]
    return values, last


class Lattice:
    """Pieces and their hash table; weights are given with each call.

    Edges are pairs (length l, ids of the pieces at [i, i + l) for positions x words, -1 for
    none), in order of length; lengths that no word of the group uses are left out."""

    def __init__(self, pieces: list[bytes]):
        self.n = len(pieces)
        self.lengths = {len(p) for p in pieces}
        self.longest = max(self.lengths)
        self.table = tb.HashTable(np.array([_hash(p) for p in pieces], tb.U64))
        heads = {_hash(p[:COMMON_BYTES]) for p in pieces if len(p) > COMMON_BYTES}
        self.heads = tb.HashTable(np.array(sorted(heads), tb.U64))

    def edges(self, words: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """``words``: rows of equally many bytes."""
        size, out = words.shape[1], []
        symbols = np.ascontiguousarray(words.T).astype(tb.U64) + tb.U64(1)
        h, some = np.zeros_like(symbols), slice(None)
        for l in range(1, min(size, self.longest) + 1):
            h = h[:size - l + 1] * tb.U64(tb.HASH_BASE) + symbols[l - 1:]
            if l in self.lengths:
                ids = np.full((size - l + 1, len(words)), -1, np.int32)
                ids[:, some] = self.table.find(h.ravel()).reshape(h.shape)
                if (ids >= 0).any():
                    out.append((l, ids))
            if l == COMMON_BYTES:
                some = np.flatnonzero((self.heads.find(h.ravel()) >= 0).reshape(h.shape).any(0))
                if not len(some):
                    break
                h, symbols = h[:, some], symbols[:, some]
        return out

    def forward(self, edges: list[tuple[int, np.ndarray]], logs: np.ndarray, size: int) -> np.ndarray:
        """Log probability of the first j bytes, for all j (positions x words)."""
        alpha = np.full((size + 1, edges[0][1].shape[1]), -np.inf)
        alpha[0] = 0
        for j in range(1, size + 1):
            alpha[j] = _sum(np.array([alpha[j - l] + logs[e[j - l]] for l, e in edges if l <= j]))
        return alpha

    def backward(self, edges: list[tuple[int, np.ndarray]], logs: np.ndarray, size: int) -> np.ndarray:
        """Log probability of the bytes from j on, for all j."""
        beta = np.full((size + 1, edges[0][1].shape[1]), -np.inf)
        beta[size] = 0
        for i in range(size - 1, -1, -1):
            beta[i] = _sum(np.array([beta[i + l] + logs[e[i]] for l, e in edges if i + l <= size]))
        return beta

    def _ending(self, word: np.ndarray, lo: int, hi: int, back: bool) -> list[tuple[int, np.ndarray]]:
        """Ids of the pieces that end at lo + 1 .. hi; ``back``: counted from the end of the word,
        where a piece ends at its first byte."""
        n, out = len(word), []
        left = n - hi if back else max(0, lo - self.longest)
        part = word[left:min(n, n - lo + self.longest) if back else hi]
        for l, ids in self.edges(part[None]):
            found = np.full(hi - lo, -1, np.int32)
            ids = ids[:, 0]
            if back:
                ids = ids[:hi - lo]
                found[:len(ids)] = ids
                found = found[::-1]
            else:
                ids = ids[max(0, len(ids) - (hi - lo)):]
                found[len(found) - len(ids):] = ids
            out.append((l, found))
        return out

    def walk(self, word: np.ndarray, logs: np.ndarray, back: bool = False):
        """The recursion over one very long word, forward or from its end, a stretch at a time:
        (lo, hi, ids of the pieces ending at lo + 1 .. hi, values at lo + 1 - longest .. hi)."""
        state = np.full(self.longest, -np.inf)  # at lo, lo - 1, ...
        state[0] = 0
        for lo in range(0, len(word), STRETCH):
            hi = min(len(word), lo + STRETCH)
            ids = self._ending(word, lo, hi, back)
            values = self._advance([(l, logs[x]) for l, x in ids], state)
            known = np.concatenate((state[::-1], values))
            yield lo, hi, ids, known
            state = known[:-self.longest - 1:-1]

    @staticmethod
    def _advance(weights: list[tuple[int, np.ndarray]], state: np.ndarray) -> np.ndarray:
        n, wide = len(weights[0][1]), weights[-1][0]
        count = n // SEGMENT
        state, out = state[:wide], []
        if count:
            cut = count * SEGMENT
            parts = [(l, w[:cut].reshape(count, SEGMENT).T) for l, w in weights]  # steps x segments
            # From each value before a segment to each of the last ones in it.
            unit = np.full((wide, wide), -np.inf)
            np.fill_diagonal(unit, 0)
            _, last = _steps([(l, w[:, :, None]) for l, w in parts], [np.tile(unit[d], (count, 1)) for d in range(wide)])
            maps, starts = np.array(last), []  # to x segments x from
            for c in range(count):
                starts.append(state)
                state = _sum((maps[:, c] + state).T.copy())
            values, _ = _steps(parts, list(np.array(starts).T))
            out.append(np.array(values).T.ravel())
            weights = [(l, w[cut:]) for l, w in weights]
        if n % SEGMENT:
            out.append(np.array(_steps([(l, w[:, None]) for l, w in weights], list(state[:, None]))[0])[:, 0])
        return np.concatenate(out)

    def log_prob(self, words: np.ndarray, logs: np.ndarray) -> np.ndarray:
        """Log of the marginal over all segmentations of each row of bytes."""
        if words.shape[1] < LONG:
            return self.forward(self.edges(words), logs, words.shape[1])[-1]
        out = np.empty(len(words))
        for i, word in enumerate(words):
            for *_, known in self.walk(word, logs):
                out[i] = known[-1]
        return out

    def expect(self, words: np.ndarray, weights: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece over all segmentations of words that occur so many ``times``.

        Words of up to ``PLAIN`` bytes are summed without logarithms: a segmentation of
        that length is far from underflow."""
        size, out = words.shape[1], np.zeros(self.n + 1)  # the last place takes what is no piece
        if size >= LONG:
            logs = log_weights(weights)
            for word, count in zip(words, times.tolist()):
                beta = np.empty(size + 1)
                beta[size] = 0
                for lo, hi, _, known in self.walk(word, logs, back=True):
                    beta[size - hi:size - lo] = known[self.longest:][::-1]
                for lo, hi, ids, known in self.walk(word, logs):
                    for l, e in ids:
                        use = np.exp(known[self.longest - l:][:hi - lo] + logs[e] + beta[lo + 1:hi + 1] - beta[0])
                        out += np.bincount(e % (self.n + 1), use * count, self.n + 1)
            return out[:-1]
        edges = self.edges(words)
        if size > PLAIN:
            logs = log_weights(weights)
            alpha, beta = self.forward(edges, logs, size), self.backward(edges, logs, size)
            for l, e in edges:
                use = np.exp(alpha[:size - l + 1] + logs[e] + beta[l:] - alpha[size]) * times
                out += np.bincount(e.ravel() % (self.n + 1), use.ravel(), self.n + 1)
            return out[:-1]
        w = np.append(weights, 0.0)
        use = [(l, w[e]) for l, e in edges]
        alpha, beta = np.zeros((size + 1, len(words))), np.zeros((size + 1, len(words)))
        alpha[0] = beta[size] = 1
        for j in range(1, size + 1):
            for l, u in use:
                if l <= j:
                    alpha[j] += alpha[j - l] * u[j - l]
        for i in range(size - 1, -1, -1):
            for l, u in use:
                if i + l <= size:
                    beta[i] += beta[i + l] * u[i]
        for (l, u), (_, e) in zip(use, edges):
            u *= alpha[:size - l + 1]
            u *= beta[l:]
            u *= times / alpha[size]
            real = e >= 0
            out[:-1] += np.bincount(e[real], u[real], self.n)
        return out[:-1]


def shares(uses: np.ndarray, ends: int) -> tuple[np.ndarray, float]:
    """Probabilities of the pieces and of the end, from expected counts over the prior and the number of texts."""
    total = uses.sum() + ends + 1
    return uses / total, (ends + 1) / total


def log_weights(weights: np.ndarray) -> np.ndarray:
    """Natural logs, with minus infinity at index -1 (no such piece)."""
    with np.errstate(divide="ignore"):
        return np.append(np.log(weights), -np.inf)


def word_groups(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Words (spans) of one length at a time, at most CHUNK: (which, rows of lower-case bytes after a blank)."""
    lens = ends - starts
    order = np.argsort(lens, kind="stable")
    cuts = np.flatnonzero(np.diff(lens[order])) + 1
    for group in np.split(order, cuts):
        if len(group):
            size = int(lens[group[0]])
            step = max(1, CHUNK * 16 // (size + 16))
            for which in (group[i:i + step] for i in range(0, len(group), step)):
                rows = np.full((len(which), size + 1), 32, np.uint8)
                rows[:, 1:] = tb.LOWER[buf[starts[which][:, None] + np.arange(size)]]
                yield which, rows


PART = T.StructType([T.StructField("h", T.LongType()), T.StructField("b", T.LongType()),
                     T.StructField("n", T.LongType()), T.StructField("t", T.BinaryType())])
USES = T.StructType([T.StructField("piece", T.LongType()), T.StructField("w", T.DoubleType())])


def part_counts(rows: DataFrame) -> DataFrame:
    """Training count of every distinct word of each block, and its bytes if that isn't 0.

    ``rows``: block, text, train."""
    arrow = to_arrow_schema(PART)

    def run(batches):
        blocks: dict[int, list] = {}

        def close(block):
            h, n, texts = blocks.pop(block)
            hashes, inverse = np.unique(np.concatenate(h), return_inverse=True)
            counts = np.bincount(inverse, np.concatenate(n), len(hashes)).astype(np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array(hashes.view(np.int64)), pa.array(np.full(len(hashes), block), pa.int64()), pa.array(counts),
                pa.array([texts.get(x) for x in hashes.tolist()], pa.binary())], schema=arrow)

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            train = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            buf, offs = tb.string_buffers(batch.column(1))
            for lo, hi, b, o in tb.slices(buf, offs):
                starts, ends, first = tb.word_spans(b, o, tb.NONSPACE)
                hashes = tb.span_hashes(b, starts, ends, tb.LOWER)
                for block in np.unique(ids[lo:hi]).tolist():
                    mine = np.repeat(ids[lo:hi] == block, np.diff(first))
                    h, at, inverse = np.unique(hashes[mine], return_index=True, return_inverse=True)
                    n = np.bincount(inverse, np.repeat(train[lo:hi], np.diff(first))[mine], len(h)).astype(np.int64)
                    old = blocks.setdefault(block, [[], [], {}])
                    old[0].append(h)
                    old[1].append(n)
                    s, e = starts[mine][at], ends[mine][at]
                    low = tb.LOWER[b].tobytes()
                    for key, x, y in zip(h[n > 0].tolist(), s[n > 0].tolist(), e[n > 0].tolist()):
                        if key not in old[2]:
                            old[2][key] = low[x:y]
                # Texts come in block order; a block that comes back later is simply sent in two parts.
                for block in [x for x in blocks if x != ids[hi - 1]]:
                    yield close(block)
        for block in list(blocks):
            yield close(block)

    return rows.mapInArrow(run, PART)


def piece_uses(words: DataFrame, shared) -> DataFrame:
    """Per task: expected uses of the pieces over the segmentations of the words (t, and c times each)."""
    arrow = to_arrow_schema(USES)

    def run(batches):
        lattice, weights = shared.value
        expected = np.zeros(lattice.n)
        for batch in batches:
            buf, offs = tb.string_buffers(batch.column(0).cast(pa.large_binary()).view(pa.large_string()))
            times = batch.column(1).to_numpy()
            for lo, hi, b, o in tb.slices(buf, offs):
                for which, group in word_groups(b, o[:-1], o[1:]):
                    expected += lattice.expect(group, weights, times[lo:hi][which])
        at = np.flatnonzero(expected)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(expected[at])], schema=arrow)

    return words.mapInArrow(run, USES)


SCORES = [T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()),
          T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("mixed_score", T.DoubleType())]


def score_block(texts: pa.Table, words: pa.Table, shared) -> dict:
    """Scores of the texts of one block, given the training counts of its words."""
    lattice, logs, log_end, n_total, n_distinct, n_texts = shared.value
    keys, at = np.unique(words.column("h").to_numpy().view(tb.U64), return_index=True)
    counts = words.column("c").to_numpy()[at]
    out: dict[str, list] = {f.name: [] for f in SCORES}
    log_total = np.log10(n_total + n_distinct + 1)
    new = max(n_distinct, 1)
    log_model = np.log10(n_total + new + 1)
    memo = np.full(len(keys), np.nan)  # log marginal of each distinct word
    buf, offs = tb.string_buffers(texts.column("text"))
    for _, _, b, o in tb.slices(buf, offs):
        starts, ends, first = tb.word_spans(b, o, tb.NONSPACE)
        place = np.searchsorted(keys, tb.span_hashes(b, starts, ends, tb.LOWER))
        todo, seen = np.unique(place, return_index=True)
        fresh = np.isnan(memo[todo])
        todo, seen = todo[fresh], seen[fresh]
        for which, group in word_groups(b, starts[seen], ends[seen]):
            memo[todo[which]] = lattice.log_prob(group, logs)
        c = counts[place]
        pad = lambda x: np.concatenate(([0], np.cumsum(x)))[first]
        n = np.diff(first) + 1
        out["n_tokens"].append(n)
        out["n_known"].append(np.diff(pad(c > 0)) + (n_texts > 0))
        out["train_tokens"].append(np.full(len(n), n_total))
        with np.errstate(divide="ignore"):
            mixed = np.logaddexp(np.log(c), np.log(new) + memo[place]) / LN10 - log_model
        rows, count_end = np.repeat(np.arange(len(n)), n - 1), np.log10(n_texts + 1)
        for name, values, end in (("base_score", np.log10(c + 1) - log_total, count_end - log_total),
                                  ("score", memo[place] / LN10, log_end / LN10), ("mixed_score", mixed, count_end - log_model)):
            out[name].append(np.bincount(rows, values, len(n)) + end)
    return {k: np.concatenate(v) if v else np.zeros(0) for k, v in out.items()}


def score(df: DataFrame, train: Column, tokenizer: str, block: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, train, n_tokens, n_known, train_tokens, base_score, score and mixed_score of every text.

    ``train``: which rows the counts are learned from. ``block``: a fixed value of each
    row that names its block (rows of a block are scored together, so a block is to hold
    some ten megabytes of text; ``blocks`` makes one)."""
    spark = df.sparkSession
    sc = spark.sparkContext
    lattice = Lattice(pieces := vocabulary_pieces(tokenizer))
    prior = prior_weights(len(pieces))
    rows = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                     F.coalesce(train, F.lit(False)).alias("train"), block.cast("long").alias("b"))
    word = Window.partitionBy("h")
    path = scratch_path(spark, "lattice-words")
    # The first row of a training word is one with its bytes.
    (part_counts(rows.select("b", "text", "train"))
     .withColumn("c", F.sum("n").over(word))
     .withColumn("first", F.row_number().over(word.orderBy(F.col("t").isNull(), "b")) == 1)
     .select("h", "b", "c", "first", F.when(F.col("first"), F.col("t")).alias("t")).write.parquet(path))
    table = spark.read.parquet(path)
    once = table.where("first and c > 0")
    n_words, n_distinct = once.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("c")).first()
    n_texts = df.where(F.coalesce(train, F.lit(False))).count()
    weights = prior
    for _ in range(ROUNDS):
        uses = piece_uses(once.select("t", "c"), sc.broadcast((lattice, weights)))
        got = uses.groupBy("piece").agg(F.sum("w").alias("w")).toArrow()  # at most the pieces of the vocabulary
        expected = PRIOR * prior
        expected[got.column(0).to_numpy()] += got.column(1).to_numpy()
        weights, end = shares(expected, n_texts)
    model = sc.broadcast((lattice, log_weights(weights), np.log(end), n_words + n_texts, n_distinct + (n_texts > 0), n_texts))
    fields = [df.schema[id_col], T.StructField("train", T.BooleanType()), *SCORES]

    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        found = score_block(texts, words, model)
        return pa.table({id_col: texts.column(id_col), "train": texts.column("train")}
                        | {f.name: pa.array(found[f.name], pa.int64() if isinstance(f.dataType, T.LongType) else pa.float64()) for f in SCORES})

    words = table.select("b", "h", "c")
    return rows.groupBy("b").cogroup(words.groupBy("b")).applyInArrow(run, T.StructType(fields))


def file_blocks(df: DataFrame, text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> Column:
    """Block of each row of a parquet scan: its file and its place in it, whatever the splits."""
    rows, size = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(text_col))).first()
    per = max(1, int(block_bytes * rows / size)) if size else 1 << 20
    return F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / per))
