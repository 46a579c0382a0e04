"""Fill-in-the-middle: against a plain regular-expression version, ranks against counting."""

import hashlib
import re

import numpy as np
import pytest
from llm_helpers import by_id, document, tables  # noqa: F401
from pyspark.sql import functions as F

from chainmetrics.llm import fim, queries

UNIT = {"line": r"[^\n]*\n|[^\n]+", "word": r"[^ \t\n\v\f\r]*[ \t\n\v\f\r]|[^ \t\n\v\f\r]+"}


def plain(doc_id, text, unit="line", percent=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(UNIT[unit], text)
    hexes = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexes[8 * j:8 * j + 8], 16) for j in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = ["", None, "\n", "\n\n\n", "one line", "one\ntwo\nthree", "one\ntwo\nthree\n", "é\nüß\n\n日本語\n𝄞x", "a<P>b\nc", "x<\nS>\n<M\n>y\n",
         "<M", "<\n<S\n<P\n", "a\r\nb c\x85d\n", "w " * 400 + "\n" + "long\n" * 90_000, "x" * 300_000, "\x00\n\x00"]


def test_wavelet_ranks_and_selects():
    rng = np.random.default_rng(5)
    for size in (0, 1, 63, 64, 65, 1000):
        x = rng.integers(0, 4, size).astype(np.uint8)
        wm = fim.WaveletMatrix(x)
        i = np.arange(size + 1)
        for c in range(4):
            assert (wm.rank(c, i) == np.concatenate(([0], np.cumsum(x == c)))).all()
        total = int(((x == 1) | (x == 2)).sum())
        ends = np.flatnonzero((x == 1) | (x == 2)) + 1
        got = wm.select_end((1, 2), np.arange(1, total + 1), np.zeros(total, np.int64), np.full(total, size))
        assert (got == ends).all()


@pytest.mark.parametrize("unit", ["line", "word"])
def test_same_as_regular_expression(spark, unit):
    rows = [(i * 100 + j, t) for i in range(12) for j, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = by_id(fim.restore(fim.transform(df, unit=unit, percent=80)))
    forms = set()
    for i, t in rows:
        r = got[i]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(i, t, unit, percent=80), i
        assert r.restored == (t or "")
        forms.add(r.form)
    assert forms == {"plain", "psm", "spm"}


def test_query(spark, tables):
    rows = [document(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id\nx", None, None, None)] * 2
    got = queries.QUERIES["op11_fill_in_middle"](spark, tables(documents=rows)).collect()
    want = [(r[0], *plain(r[0], r[1])[:4], *(hashlib.sha256(x.encode()).hexdigest() for x in (plain(r[0], r[1])[4], r[1] or ""))) for r in rows]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_edges(spark):
    df = spark.createDataFrame([(1, "a\nb", "n", 5)], "doc_id long, text string, form string, n int")
    got = fim.transform(df)
    assert sorted(got.columns) == sorted(["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"])
    assert got.first().form != "n"
    assert fim.transform(df.limit(0)).count() == 0
    assert fim.transform(df, percent=0).first().form == "plain"
    assert fim.transform(df.withColumn("text", F.lit(None).cast("string"))).first().output == ""
    with pytest.raises(ValueError):
        fim.transform(df, unit="page")
