"""String-kernel language identification: held-out accuracy and edges."""

import math
import random
import zlib

import numpy as np
from llm_helpers import by_id, document, SF_CHECK, tables  # noqa: F401

from chainmetrics.llm import langid, queries


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "lang")
    got = queries.QUERIES["op7_langid"](spark, SF_CHECK).join(docs, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_undetermined_and_untrained(spark, tables):
    r = random.Random(1)
    kinds = {"aa": "abcde ", "bb": "uvwxyz "}
    rows = [document(i, "".join(r.choice(kinds[k]) for _ in range(200)), k if i % 9 else None) for i in range(80) for k in [r.choice("ab") * 2]]
    rows += [document(900, None, None), document(901, "", None), document(902, "123 !!", None), document(903, "abcab", None), document(904, "Ω", None)]
    got = by_id(queries.QUERIES["op7_langid"](spark, tables(documents=rows)))
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (900, 901, 902))
    assert got[903].lang_pred == "aa" and got[904].lang_pred in ("aa", "bb")
    assert all(got[i].lang_pred == ("aa" if set(t or "") & set("abcde") else "bb") for i, t, *_ in rows[:80])
    none = langid.identify(spark.createDataFrame([(1, "abc", None, "x")], "doc_id long, text string, lang string, lang_pred string"))
    assert [(x.lang_pred, x.score) for x in none.collect()] == [("und", 0.0)]
    assert langid.identify(none.select("doc_id", "text", "lang").limit(0)).count() == 0


def test_prediction_reads_only_the_text(spark, tables):
    rows = [document(i, ("der die und " if i % 2 else "the and of ") * 9, "de" if i % 2 else "en") for i in range(60)]
    first = by_id(queries.QUERIES["op7_langid"](spark, tables(documents=rows)))
    # Other labels on held-out rows, other sources everywhere: nothing changes.
    other = [(i, t, "en" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, "elsewhere", 0) for i, t, lang, *_ in rows]
    assert by_id(queries.QUERIES["op7_langid"](spark, tables(documents=other))) == first


def test_folded_scores_equal_kernel_ridge():
    """Margins from kernels with the landmarks and a ridge solution in their span, nothing folded."""
    r = random.Random(3)
    kinds = {"aa": "abcde ", "bb": "cdefgh ", "cc": "éüabx "}
    texts = [("".join(r.choice(kinds[k]) for _ in range(r.randint(5, 80))), k) for k in kinds for _ in range(25)]
    seen = np.zeros(langid.BASES[3], bool)

    def columns(text):
        return langid.presence(langid.ALPHABET[np.frombuffer(text.encode(), np.uint8)], seen)

    def kernel(x, z):
        return len(x & z) / math.sqrt(len(x) * len(z))

    labels, sets = [k for _, k in texts], [columns(t) for t, _ in texts]
    model = langid.Model(labels, sets)
    grams = [set(s.tolist()) for s in sets]
    share = langid.LANDMARKS // 3
    marks = [grams[i] for k in kinds for i in [j for j, l in enumerate(labels) if l == k][:share]]
    k_nm = np.array([[kernel(x, z) for z in marks] for x in grams])
    k_mm = np.array([[kernel(x, z) for z in marks] for x in marks])
    y = np.array([[1.0 if l == k else -1.0 for k in kinds] for l in labels])
    full = np.hstack((k_nm, np.ones((len(grams), 1))))
    penalty = np.zeros((len(marks) + 1,) * 2)
    penalty[:-1, :-1] = langid.RIDGE * len(grams) * k_mm
    solution = np.linalg.lstsq(full.T @ full + penalty, full.T @ y, rcond=None)[0]
    fresh = ["".join(r.choice(kinds[k]) for _ in range(n)) for k in kinds for n in (1, 3, 30, 400)]
    fresh = [t if any(c.isalpha() for c in t) else t + "a" for t in fresh]
    data = "".join(fresh).encode()
    offs = np.cumsum([0] + [len(t.encode()) for t in fresh])
    pred, score = model.predict(np.frombuffer(data, np.uint8), offs)
    for text, p, s in zip(fresh, pred, score):
        x = set(columns(text).tolist())
        margin = np.append([kernel(x, z) for z in marks], 1) @ solution
        soft = np.exp(langid.SHARPNESS * (margin - margin.max()))
        assert p == list(kinds)[margin.argmax()] and math.isclose(s, soft.max() / soft.sum(), rel_tol=1e-3)
