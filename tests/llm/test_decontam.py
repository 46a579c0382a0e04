"""Winnowing against a brute-force search of every window."""

import hashlib
import random

import pytest
from llm_helpers import by_id, document, tables, words  # noqa: F401
from pyspark.sql import functions as F

from chainmetrics.llm import decontam, queries

PATTERN = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(docs, bench):
    windows = {}
    for item, text in bench:
        w = words(text, PATTERN)
        size = min(13, len(w))
        for j in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[j:j + size]), set()).add(item)
    out = {}
    for i, text in docs:
        w, hit, items = words(text, PATTERN), set(), set()
        for size in {len(k) for k in windows}:
            for j in range(len(w) - size + 1):
                if (k := tuple(w[j:j + size])) in windows:
                    hit.update(range(j, j + size))
                    items |= windows[k]
        out[i] = (len(w), len(hit), sorted(x for x in items if x is not None))
    return out


def cases(seed):
    r = random.Random(seed)
    vocabulary = ["a", "B", "c3", "é", "dd", *(f"w{i}" for i in range(r.choice([0, 4, 30])))]

    def text(n):
        return " ".join(r.choice(vocabulary) for _ in range(n))

    bench = [(r.randint(0, 12), text(r.choice([0, 1, 3, 5, 12, 13, 14, 40]))) for _ in range(8)]
    bench += [(99, bench[0][1]), (3, None), (None, text(14)), (4, "")]
    docs = [text(r.randint(0, 70)) for _ in range(25)] + [None, "", "...", "A" * 3000]
    docs += [f"{text(5)} {t}; {text(7)}" for _, t in bench]
    return list(enumerate(docs)), bench


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("block_words", [1_000_000, 20])
def test_find_equals_brute_force(spark, seed, block_words):
    docs, bench = cases(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(bench, "item_id long, text string").repartition(2)
    found = by_id(decontam.find_contamination(d, b, block_words=block_words))
    want = brute(docs, bench)
    assert {i: (r.n_words, r.n_hit, r["items"]) for i, r in found.items()} == want
    for r in found.values():
        assert sum(s.end - s.start for s in r.hit_spans) == r.n_hit


def test_query(spark, tables):
    docs, bench = cases(7)
    folder = tables(documents=[document(i, t) for i, t in docs], benchmark=bench)
    got = by_id(queries.QUERIES["op1_decontamination"](spark, folder))
    for i, (n, hit, items) in brute(docs, bench).items():
        listed = ",".join(sorted(map(str, items)))
        assert (got[i].n_words, got[i].n_hit, got[i].n_items) == (n, hit, len(items))
        assert got[i].items_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert got[i].contaminated == (hit > 0 and 20 * hit >= n)


def test_edges(spark):
    d = spark.createDataFrame([(1, "x y", 5, "k"), (1, "x y", 5, "k")], "doc_id long, text string, n_words int, extra string")
    none = spark.createDataFrame([], "item_id long, text string")
    out = decontam.find_contamination(d, none)
    assert out.where((F.col("n_words") == 2) & (F.col("n_hit") == 0) & (F.col("extra") == "k")).count() == 2
    assert decontam.find_contamination(d.limit(0), none).count() == 0
