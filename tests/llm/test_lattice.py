"""Language-model scores against sums over all segmentations."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import by_id, document, tables, words  # noqa: F401
from pyspark.sql import functions as F

from chainmetrics.llm import lattice, queries

PATTERN = rb"[^\x20\x09-\x0D]+"


def test_forward_sums_all_segmentations(monkeypatch):
    pieces = [bytes([b]) for b in b" abc"] + [b" a", b"ab", b"bc", b"abc", b" ab"]
    prior = lattice.prior_weights(9)
    net, logs = lattice.Lattice(pieces), lattice.log_weights(prior)
    weight = dict(zip(pieces, prior))

    def total(text):
        return 1.0 if not text else sum(weight[text[:i]] * total(text[i:]) for i in range(1, len(text) + 1) if text[:i] in weight)

    for text in (b" a", b" abc", b" abcab", b" cccabcabc"):
        rows, times = np.frombuffer(text, np.uint8)[None].repeat(3, 0), np.array([1, 4, 2])
        assert np.allclose(net.log_prob(rows, logs), math.log(total(text)))
        lens = np.array([len(p) for p in pieces])
        uses = net.expect(rows, prior, times)
        assert math.isclose((uses * lens).sum(), 7 * len(text), rel_tol=1e-9)  # the pieces cover the word
        monkeypatch.setattr(lattice, "PLAIN", 0)
        assert np.allclose(net.expect(rows, prior, times), uses)  # with and without logarithms
        monkeypatch.undo()


@pytest.mark.parametrize("size", [40, 64, 65, 163, 700])
def test_segments_of_very_long_words(monkeypatch, size):
    """Walking segments side by side gives what the plain recursion gives, long pieces over the cuts included."""
    pieces = [bytes([b]) for b in b" -ab"] + [b"ab", b"aba", b"-" * 17, b"-" * 24, b"-" * 33, b"b" + b"-" * 20]
    prior = lattice.prior_weights(len(pieces))
    net, logs = lattice.Lattice(pieces), lattice.log_weights(prior)
    r = random.Random(size)
    text = b" " + b"".join(r.choice([b"a", b"b", b"ab", b"-" * r.randint(1, 60)]) for _ in range(size))
    rows = np.frombuffer(text[:size], np.uint8)[None]
    plain, uses = net.log_prob(rows, logs), net.expect(rows, prior, np.array([3]))
    for name, value in (("LONG", 8), ("SEGMENT", 16), ("STRETCH", 80)):
        monkeypatch.setattr(lattice, name, value)
    assert np.allclose(net.log_prob(rows, logs), plain, rtol=1e-12)
    assert np.allclose(net.expect(rows, prior, np.array([3])), uses, rtol=1e-9)


def test_every_piece_of_the_vocabulary_is_used():
    """Long pieces, too: a word that is one piece is at least as probable as that piece."""
    pieces = lattice.vocabulary_pieces(queries.byte_bpe_file())
    net, weights = lattice.Lattice(pieces), lattice.prior_weights(len(pieces))
    long = [i for i, p in enumerate(pieces) if len(p) > 16]
    assert len(long) > 50 and max(len(pieces[i]) for i in long) > 64
    for i in long:
        rows = np.frombuffer(pieces[i], np.uint8)[None]
        assert net.log_prob(rows, lattice.log_weights(weights))[0] >= math.log(weights[i])


def test_query_base_score_and_probabilities(spark, tables):
    r = random.Random(4)
    rows = [document(i, " ".join(r.choice(["The", "cat", "sat", f"w{r.randint(0, 30)}", "éa"]) for _ in range(r.randint(0, 30)))) for i in range(60)]
    rows += [document(100, None), document(101, ""), document(102, "unseenword"), document(103, "x" * 3000), document(104, "\t\n")]
    got = by_id(queries.QUERIES["op8_lm_scoring"](spark, tables(documents=rows)))
    train = [t for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in [*words(t, PATTERN), None])
    n, v = sum(counts.values()), len(counts)
    for i, text, *_ in rows:
        tokens, row = [*words(text, PATTERN), None], got[i]
        assert row.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert math.isclose(row.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), rel_tol=1e-9)
        assert row.score < 0 and math.isfinite(row.score)
        # The mix: at least the counts alone, less than certainty.
        least = sum(math.log10(counts[w] / (n + v + 1)) if counts[w] else -math.inf for w in tokens)
        assert least - 1e-9 <= row.mixed_score < 0 and math.isfinite(row.mixed_score)


def test_without_training_texts_and_empty(spark):
    df = spark.createDataFrame([(1, "a b", 1), (1, "a b", 1), (None, None, 1)], "doc_id long, text string, score int")
    out = lattice.score(df, F.lit(False), queries.byte_bpe_file(), F.lit(0)).collect()
    assert len(out) == 3 and all(math.isfinite(r.score) and r.train_tokens == 0 and r.n_known == 0 for r in out)
    assert lattice.score(df.limit(0), F.lit(True), queries.byte_bpe_file(), F.lit(0)).count() == 0


def test_scores_do_not_depend_on_blocks(spark):
    """Piece weights are a statistic of the corpus: any blocks and partitions give the same scores."""
    r = random.Random(6)
    texts = [" ".join(r.choice(["the", "cat", "telephone", "élan", f"word{r.randint(0, 40)}"]) for _ in range(20)) for _ in range(60)] + ["", "", "", "", "", "unseenword cats"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    train, file = F.col("doc_id") % 7 != 2, queries.byte_bpe_file()
    one = by_id(lattice.score(df.coalesce(1), train, file, F.lit(0)))
    many = by_id(lattice.score(df.repartition(5), train, file, F.col("doc_id") % 9))
    assert all(math.isclose(one[i].score, many[i].score, rel_tol=1e-9) for i in one) and len(one) == len(many) == 66
    # Two rounds over the training words by plain sums over the splits of each, known words and all.
    pieces = lattice.vocabulary_pieces(file)
    prior = lattice.prior_weights(len(pieces))
    place = {p: i for i, p in enumerate(pieces)}
    training = Counter(w for i, t in enumerate(texts) if i % 7 != 2 for w in t.encode().split())
    n_texts = sum(i % 7 != 2 for i in range(len(texts)))

    def sums(word, weights):
        """Forward and backward sums over the edges of a word, without logarithms."""
        edges = [(i, j, place[word[i:j]]) for i in range(len(word)) for j in range(i + 1, len(word) + 1) if word[i:j] in place]
        left, right = [1.0] + [0.0] * len(word), [0.0] * len(word) + [1.0]
        for i, j, p in sorted(edges):
            left[j] += left[i] * weights[p]
        for i, j, p in sorted(edges, reverse=True):
            right[i] += right[j] * weights[p]
        return edges, left, right

    weights = prior
    for _ in range(2):
        uses = lattice.PRIOR * prior
        for w, c in training.items():
            edges, left, right = sums(b" " + w, weights)
            for i, j, p in edges:
                uses[p] += c * left[i] * weights[p] * right[j] / right[0]
        mass = uses.sum() + n_texts + 1
        weights, end = uses / mass, (n_texts + 1) / mass
    for i, t in enumerate(texts):
        want = math.log10(end) + sum(math.log10(sums(b" " + w, weights)[2][0]) for w in t.encode().split())
        assert math.isclose(one[i].score, want, rel_tol=1e-9)
    assert math.isclose(weights.sum() + end, 1)
