"""Repeated 100-byte strings against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pytest
from llm_helpers import by_id, document, tables  # noqa: F401

from chainmetrics.llm import queries, suffixes


def brute(rows):
    """id -> (kept bytes, removed ranges)."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for j in range(len(b) - 99):
            if b[j:j + 100] in seen:
                gone[j:j + 100] = b"\x01" * 100
            seen.add(b[j:j + 100])
        edges = [k for k in range(len(b) + 1) if (k < len(b) and gone[k]) != (k > 0 and gone[k - 1] == 1)]
        out[i] = (bytes(c for c, g in zip(b, gone) if not g), list(zip(edges[::2], edges[1::2])))
    return out


def corpus(seed):
    r = random.Random(seed)

    def noise(n):
        return "".join(r.choice("abcdefgh ") for _ in range(n))

    base = [noise(r.randint(50, 600)) for _ in range(10)]
    rows = []
    for i in range(80):
        parts = []
        for _ in range(r.randint(0, 4)):
            t = r.choice(base)
            a = r.randint(0, len(t))
            parts += [t[a:r.randint(a, len(t))], noise(r.choice([0, 1, 30, 120]))]
        rows.append((3 * i, "".join(parts)))
    # One passage in every document of a group, copies, periodic and multi-byte texts, null and empty ones.
    rows += [(500 + i, noise(40) + base[3] + noise(40)) for i in range(40)] + [(600 + i, base[5]) for i in range(20)]
    rows += [(1000, "a" * 500), (1001, "a" * 350), (1002, "ab" * 300), (1003, None), (1004, ""), (1005, "é" * 200),
             (1006, "x" + "é" * 120), (1007, base[1] + base[1])]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, batch_bytes, least, hot", [(1, 1 << 40, 1, 20_000), (2, 8_000, 1, 20_000), (3, 1 << 40, 2, 3)])
def test_equals_brute_force(spark, monkeypatch, seed, batch_bytes, least, hot):
    """One batch; several batches, whose levels merge; and hot keys dealt to several groups."""
    monkeypatch.setattr(suffixes, "HOT", hot)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = by_id(suffixes.remove_repeats(df, batch_bytes=batch_bytes, least=least))
    assert {i: (bytes(r.kept), [(s.start, s.end) for s in r.spans]) for i, r in got.items()} == brute(rows)


def test_copies_need_key_and_body():
    """Two heads whose bodies have the same 64-bit hash are no copies of each other, in one call or in two."""
    u, sent = lambda *x: np.array(x, np.uint64), suffixes.Sent()
    order, copy = sent.copies(u(1, 2, 1, 1), u(7, 7, 7, 8), np.array([0, 1, 2, 3]), np.array([0, 0, 0, 0]))
    assert {int(i) for i, c in zip(order, copy) if c} == {2}
    order, copy = sent.copies(u(1, 2, 3, 1), u(7, 7, 7, 8), np.array([4, 5, 6, 7]), np.array([0, 0, 0, 0]))
    again = {int(i) for i, c in zip(order, copy) if c}
    assert 2 not in again and 3 in again and len(again & {0, 1}) == 1


def test_levels_merge_geometrically(spark):
    rows = corpus(4)
    df = spark.createDataFrame(rows, "doc long, text string").na.fill("")
    family, sizes = suffixes.Family(spark), []
    for i in range(5):
        family.add(df.where(f"doc % 5 = {i}"))
        sizes.append([s for s, _ in family.levels])
    # Two ones become a two before the third batch; before the fifth, two twos a four.
    assert sizes == [[1], [1, 1], [2, 1], [2, 1, 1], [4, 1]]


def test_query_and_edges(spark, tables):
    rows = [(i, t) for i, t in corpus(5)][:60]
    got = by_id(queries.QUERIES["op2_suffix_dedup"](spark, tables(documents=[document(i, t) for i, t in rows])))
    for i, (kept, spans) in brute(rows).items():
        text = (dict(rows)[i] or "").encode()
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans) == (len(text), len(text) - len(kept), len(spans))
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()
    text = "0123456789" * 13 + "x"
    # Repeated rows are one document; an earlier null id counts as first.
    odd = spark.createDataFrame([(1, text, 0), (1, text, 0), (None, text, 0)], "doc_id long, text string, n_bytes int")
    out = {(r.doc_id, bytes(r.kept)) for r in suffixes.remove_repeats(odd).collect()}
    assert {k for k in out if k[0] == 1} == {(1, b"")}
    assert suffixes.remove_repeats(odd.limit(0)).count() == 0
