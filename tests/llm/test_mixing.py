"""Mixing: targets and pieces against plain versions, and the laws of the tree."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import document, tables  # noqa: F401

from chainmetrics.llm import mixing as M
from chainmetrics.llm import queries

WEIGHTS = (5, 2, 1)


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes, share=1.0, most=3):
    """Shares by weight; what is above a cap is dealt to the others until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        got = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if got[s] > most * sizes[s]]
        if not above:
            return got | capped
        capped |= {s: float(most * sizes[s]) for s in above}


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choices(["b", "a", "é", "z", "𝄞", "￮", None, "tiny"], weights=[50, 20, 9, 9, 9, 5, 5, 1])[0]
        rows.append((i, " ".join(f"w{i}_{j}" for j in range(rng.choice([0, 1, 5, 40, 300]))) + rng.choice(["", " \n"]), "en", source, 0))
    rows += [(1000, "long " * 20_000, "en", "a", 0), (1001, None, "en", "z", 0), (1002, "one", None, "only", 0), (1003, None, "en", "empty", 0)]
    return rows + [(None, "no id here", "en", "b", 0)] * 2 + [(7, rows[7][1], "en", rows[7][3], 0)]


def test_query_gives_every_source_its_target(spark, tables):
    rows = corpus()
    got = queries.QUERIES["op13_mixing"](spark, tables(documents=rows)).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += n_words(r[1])
    want = plain_targets(sizes)
    by_id = defaultdict(list)
    for r in rows:
        by_id[r[0]].append(r)
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    taken = defaultdict(int)
    for g in got:
        r = by_id[g.doc_id][0]
        assert (g.size, g.source_size) == (n_words(r[1]), sizes[r[3]])
        assert g.target == pytest.approx(want[r[3]], rel=1e-9)
        assert 0 <= g.taken <= 3 * g.size
        taken[r[3]] += g.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.5 + 1e-6, s


def test_reruns_and_partitionings_agree(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long")
    key = lambda r: str(r)
    one = sorted(M.mix(df.repartition(1), block_words=16).collect(), key=key)
    assert one == sorted(M.mix(df.repartition(11), block_words=16).collect(), key=key)
    assert one != sorted(M.mix(df, block_words=16, seed=8).collect(), key=key)


def test_shards_hold_the_blocks_of_the_tree(spark):
    """Pieces are words of their documents, blocks are full, shards even, passes whole."""
    rows = [r for r in corpus(2) if r[0] is not None and r[0] != 7]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    options = dict(shards=5, block_words=16)
    texts = M.mixed_texts(df, **options).collect()
    pieces = M.mix(df, **options).collect()
    assert texts == sorted(texts, key=lambda r: (r.shard, r.position, r.at)) and {r.shard for r in texts} == set(range(5))
    of = {r[0]: r for r in rows}
    blocks = defaultdict(list)
    for r in pieces:
        words = defaultdict(Counter)
        for p in r.pieces:
            blocks[p.shard, p.position].append((p.at, p.words, of[r.doc_id][3]))
            words[p["pass"]].update(range(p.first, p.first + p.words))
        assert all(c == 1 for w in words.values() for c in w.values())
        last = max(words, default=0)
        assert all(len(words[k]) == r.size for k in range(last))
    per_shard = Counter(s for s, _ in blocks)
    assert max(per_shard.values()) - min(per_shard.values()) <= 1
    for k, n in per_shard.items():
        assert {p for s, p in blocks if s == k} == set(range(n))
    for parts in blocks.values():
        parts.sort()
        assert len({s for *_, s in parts}) == 1
        assert all(a + n == b for (a, n, _), (b, _, _) in zip(parts, parts[1:])) and sum(n for _, n, _ in parts) <= 16
    again = Counter()
    for t in texts:
        again[t.doc_id] += n_words(t.text)
    assert all(again[r.doc_id] == sum(p.words for p in r.pieces) for r in pieces)
    for t in texts[:200]:
        assert t.text in of[t.doc_id][1]


def test_splits_are_hypergeometric():
    quotas = [400, 0, 35, 1, 64]
    draws = np.array([M.split_quotas(quotas, 7, seed) for seed in range(400)])
    assert (draws.sum(axis=2) == quotas).all() and (draws >= 0).all()
    assert np.ptp(draws.sum(axis=1), axis=1).max() <= 1
    size, n = 500 / 7, 500
    for s, q in enumerate(quotas):
        assert abs(draws[:, s].mean() - q / 7) < 0.05
        variance = size * (q / n) * (1 - q / n) * (n - size) / (n - 1)
        assert abs(draws[:, s].var() - variance) <= 0.12 * variance + 0.01


def test_hypergeometric_quantiles():
    from math import comb
    good, bad, draws = 30, 50, 25
    chance = [comb(good, k) * comb(bad, draws - k) / comb(80, draws) for k in range(draws + 1)]
    for u in np.linspace(0.001, 0.999, 57):
        assert M.hypergeometric(u, good, bad, draws) == int(np.searchsorted(np.cumsum(chance), u, "right"))
    big = [M.hypergeometric(u, 7 * 10**10, 3 * 10**10, 5 * 10**10) for u in (0.1, 0.5, 0.9)]
    assert big == sorted(big) and abs(big[1] - 3.5 * 10**10) < 10
    assert abs((big[2] - big[0]) / (2 * 1.2815516 * (5e10 * 0.7 * 0.3 * 0.5) ** 0.5) - 1) < 1e-3


def test_permutations():
    for size in (1, 2, 3, 17, 1000):
        for key in (1, 99):
            x = np.arange(size)
            assert sorted(M.permuted(x, np.full(size, size), np.full(size, key))) == list(range(size))
    assert (M.permuted(np.arange(100), np.full(100, 100), np.full(100, 1)) != M.permuted(np.arange(100), np.full(100, 100), np.full(100, 2))).any()


def test_edges(spark):
    schema = "doc_id long, text string, source string, size string, place int"
    df = spark.createDataFrame([(1, "a b", None, "x", 1), (2, "c", None, "x", 1)], schema)
    assert {(r.doc_id, r.size, r.source_size, r.target) for r in M.mix(df).collect()} == {(1, 2, 3, 3.0), (2, 1, 3, 3.0)}
    assert M.mix(df.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, None, "a", "", 0), (2, " ", "b", "", 0)], schema)
    assert [r.target for r in M.mix(nothing).collect()] == [0.0, 0.0]
    assert {sum(p.words for p in r.pieces) for r in M.mix(df, share=9.0).collect()} == {6, 3}  # all sources at their caps
    with pytest.raises(ValueError):
        M.mix(df, shards=0)
