"""Collocations: against counters over plain Python words, with portions, segments and merges cut small."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from llm_helpers import LOWER, document, tables  # noqa: F401
from pyspark.sql import functions as F

from chainmetrics.llm import collocations as C
from chainmetrics.llm import queries


def pieces(text):
    for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode().translate(LOWER)):
        yield [w.decode() for w in re.findall(rb"[^\x20\x09]+", piece)]


def counts(docs):
    f, n = Counter(), Counter()
    for lang, text in docs:
        for w in pieces(text):
            n[lang] += len(w)
            f.update((lang, tuple(w[j:j + s])) for s in (1, 2, 3) for j in range(len(w) - s + 1))
    return f, n


def plain(docs, least=10, share=50, top=2000):
    f, n = counts([(lang if lang is not None else "und", t) for lang, t in docs])
    found = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        longer = [f[lang, q] for (g, q) in f if g == lang and len(p) == 2 and len(q) == 3 and p in (q[:2], q[1:])]
        if any(c >= least and 100 * c >= share * a for c in longer):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, rows in found.items()
            for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top])}


def texts(seed, n):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "a", "é", "ÉCLAIR", "new", "york", "city", "x" * 300, "日本", "b-c", "d'e"]
    out = []
    for i in range(n):
        words = rng.choices(vocabulary, weights=[9, 5, 6, 6, 2, 1, 3, 3, 3, 1, 2, 2, 1], k=rng.randrange(60))
        out.append((rng.choice(["en", "de", None, "und"]),
                    "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ", ", "\n", "!", " "]) for w in words)))
    return out + [("en", None), (None, ""), ("fr", ". , \n"), ("es", "new york city. " * 12), ("es", "new york city. " * 12), ("zz", "lone words here")]


@pytest.mark.parametrize("segment_words", [1, 50, 20_000])
def test_same_as_plain_counters(spark, segment_words):
    docs = texts(3, 120)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(7)
    got = {tuple(r) for r in C.mine(df, segment_words=segment_words, least=4).collect()}
    assert got == plain(docs, least=4)
    assert {r[0] for r in got} >= {"en", "und", "es"}


def test_top_and_share(spark):
    docs = texts(4, 60)
    df = spark.createDataFrame(docs, "lang string, text string")
    assert {tuple(r) for r in C.mine(df, least=3, share=101, top=5).collect()} == plain(docs, least=3, share=101, top=5)


def test_subsumption_counts_only_frequent_longer_phrases(spark):
    docs = [("en", "p q r. " * 9 + "p q. " * 9), ("de", "p q r. " * 10 + "p q. " * 10), ("fr", "z p q. " * 10 + "p q. " * 11)]
    got = {tuple(r) for r in C.mine(spark.createDataFrame(docs, "lang string, text string")).collect()}
    assert got == plain(docs)
    assert {(g, p) for g, _, p, *_ in got} == {("en", "p q"), ("de", "q r"), ("de", "p q r"), ("fr", "p q"), ("fr", "z p q")} - {("de", "q r")}


def test_portions_and_merges_of_any_size(monkeypatch):
    """Portions cut inside texts, prefixes carried over many batches: same sums."""
    docs = [(lang or "und", t) for lang, t in texts(5, 80)]
    f, _ = counts(docs)
    batches = [pa.RecordBatch.from_arrays([pa.array([g for g, _ in part], pa.string()), pa.array([t for _, t in part], pa.string())], ["grp", "t"])
               for part in (docs[i:i + 9] for i in range(0, len(docs), 9))]
    words = sorted({w for _, p in f for w in p})
    h = C._hashes(pa.array(words, pa.string()))
    order = h.argsort()
    for combine, merge_bytes, hot in ((40, 1, 3), (1 << 20, 30, 5), (200, 1 << 20, 1)):
        monkeypatch.setattr(C, "COMBINE_BYTES", combine)
        monkeypatch.setattr(C, "MERGE_BYTES", merge_bytes)
        segmented = (h[order], (h[order] * 0 + hot)) if hot > 1 else (h[:0], h[:0])
        made = pa.Table.from_batches(C.stripes(iter(batches), segmented)).sort_by([("grp", "ascending"), ("w1", "ascending"), ("segment", "ascending")])
        got = Counter()
        for out in C.merge(iter(made.to_batches(max_chunksize=4)), 1):
            for r in out.to_pylist():
                got[r["grp"], tuple(w for w in (r["w1"], r["w2"], r["w3"]) if w is not None)] += r["n"]
        assert got == f


def test_score_beyond_64_bits(spark):
    a, left, right = 3_000_000_000_000, 5_000_000_000_000, 4_000_000_000_001
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(C._score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 10**6 * a * a // (left * right)


def test_query_and_edges(spark, tables):
    docs = [document(i, t, g) for i, (g, t) in enumerate(texts(6, 150))]
    got = {tuple(r) for r in queries.QUERIES["op12_collocations"](spark, tables(documents=docs)).collect()}
    assert got == plain([(d[2], d[1]) for d in docs])
    df = spark.createDataFrame([("g", "a b " * 30, "x", "y", 1)], "lang string, text string, grp string, w1 string, n int")
    assert {r.phrase for r in C.mine(df).collect()} == {"a b a", "b a b"}  # the pairs are parts of them
    assert C.mine(df.limit(0)).count() == 0
