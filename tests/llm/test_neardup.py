"""Near-duplicate components against an exact all-pairs join."""

import random

import numpy as np
import pytest
from llm_helpers import by_id, document, tables, words  # noqa: F401

from chainmetrics.llm import neardup, queries

PATTERN = rb"[^\x20\x09-\x0D]+"


def shingle_set(text):
    w = words(text, PATTERN)
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4))


def brute(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]

    def text(n):
        return [r.choice(vocabulary) for _ in range(n)]

    rows, i = [], 0
    for _ in range(25):
        base = text(r.choice([3, 5, 9, 40, 120, 300]))
        for _ in range(r.randint(1, 6)):
            copy = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 4])):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            rows.append((i := i + r.randint(1, 3), " ".join(copy)))
    # A chain in which only neighbours are linked, a large group of copies, odd texts.
    chain = text(200)
    for _ in range(12):
        at = r.randrange(190)
        chain = chain[:at] + text(4) + chain[at + 4:]
        rows.append((i := i + 1, "\n".join(chain).upper()))
    rows += [(i + 1 + k, "the same text of many words again and again") for k in range(30)]
    rows += [(i + 50, None), (i + 51, ""), (i + 52, " \t\n"), (i + 53, None), (i + 54, "one"), (i + 55, "One "), (i + 56, "x" * 5000)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_components_equal_brute_force(spark, tables, seed):
    rows = corpus(seed)
    got = by_id(queries.QUERIES["op3_neardup"](spark, tables(documents=[document(i, t) for i, t in rows])))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == brute(rows)
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_contested_buckets_are_compared_in_blocks(spark, monkeypatch):
    """Without the first rounds and with tiny blocks every link comes from the block comparison."""
    monkeypatch.setattr(neardup, "STAR_ROUNDS", 0)
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rows = corpus(5)
    got = by_id(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == brute(rows)


def test_sketches_merge_and_estimate():
    r = np.random.default_rng(1)
    pool = np.unique(r.integers(0, 2**63, 6000, dtype=np.uint64))
    for shared, total in ((850, 1000), (500, 1000), (100, 1000)):
        only = (total - shared) // 2
        a, b = pool[:shared + only], np.concatenate((pool[:shared], pool[2000:2000 + only]))
        sa, sb = neardup.sketch(a), neardup.sketch(b)
        assert (neardup.merge(sa, sb) == neardup.sketch(np.union1d(a, b))).all()
        est = neardup.estimate(sa[None], sb[None], np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(est - shared / (shared + 2 * only)) < 0.1


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 102), (102, 101)], "a long, b long")
    got = {r.id: r.comp for r in neardup.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_edges(spark):
    df = spark.createDataFrame([(7, "a b c d e f", 1), (7, "a b c d e f", 1), (None, "a b c d e f", 1), (9, "A b c d e f", 1)],
                               "doc_id long, text string, kept int")
    got = [(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(7, 7, True), (7, 7, True), (None, None, True), (9, 7, False)], key=str)
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_rows_of_one_id_link_by_each_of_their_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (4, b + " end"), (5, "on its own here with words"), (1, None)]
    for parts, data in ((1, rows), (1, rows[::-1]), (4, rows), (7, rows[3:] + rows[:3])):
        df = spark.createDataFrame(data, "doc_id long, text string").repartition(parts)
        got = sorted({(r.doc_id, r.component_id) for r in neardup.near_duplicates(df).collect()})
        assert got == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 5)]
