"""Rule spans against plain regular expressions; redaction; trees."""

import hashlib
import random
import re

import numpy as np
import pytest
from llm_helpers import by_id, document, tables  # noqa: F401

from chainmetrics.llm import pii, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub(r"\D", "", m[0])) <= 15]


def test_rules_equal_plain_patterns():
    r = random.Random(3)
    for alphabet in ("ab.@-+1 ", "0123. -+()", "a@b.c-", "4 -0123456789", "é@.a1"):
        for _ in range(4000):
            text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 45)))
            assert pii.rule_spans(text, True, True) == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 100_000, "a" * 100_000 + "@", "+1" + "(" * 100_000, "1." * 50_000, "@" * 100_000, "1 " * 50_000):
        pii.rule_spans(text, True, True)
        pii.candidates(text, True, True)


def sample():
    r = random.Random(8)
    out = []
    for i in range(300):
        bits = [f"mail {r.choice('abc')}{i}@host{i}.example.com now", f"call +1 (555) 010-{r.randint(1000, 9999)} today",
                f"at {i % 256}.2.3.4 é", "card 4111 1111 1111 1111 end", "no digits here", f"order 12345678{i}", f"v 1.2.3.{300 + i}"]
        out.append((i, " ".join(r.sample(bits, r.randint(0, 4)))))
    return out + [(900, None), (901, ""), (902, "é" * 5 + " a@b.cd " + "1" * 200)]


def test_query(spark, tables):
    rows = sample()
    got = by_id(queries.QUERIES["op9_pii"](spark, tables(documents=[document(i, t) for i, t in rows])))
    for i, text in rows:
        want = [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in sorted(brute(text or ""))]
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        assert set(want) <= set(got[i].spans.split(","))  or not want
        for n, kind in enumerate(pii.KINDS):
            assert got[i][f"n_{kind}"] == sum(w.startswith(kind) for w in want)


def test_redaction_and_trees(spark):
    rows = sample()
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, pii string")
    trees = pii.train(df)
    masked = by_id(pii.redact(df, trees))
    assert list(pii.redact(df, trees).columns) == ["doc_id", "text", "pii"]
    assert masked[900].text is None
    for i, text in rows:
        if text:
            assert not brute(masked[i].text)
            if not re.search(r"[@0-9]", text):
                assert masked[i].text == text
    assert pii.mask("a b@c.de x", [(0, 2, 8, True), (3, 4, 9, False)]) == "a [EMAIL]x"
    assert pii.train(df.limit(0)) is None and pii.train(df.where("doc_id in (900, 901)")) is None
    assert pii.find(df.limit(0), None).count() == 0
    # The exported trees score as nested tuples.
    assert np.allclose(pii.Trees([(0, 1.5, -1.0, (1, 0.0, 0.5, 1.0))], [1.0], {}).score(np.array([[1.0, 9], [2, -1], [2, 3]])),
                       1 / (1 + np.exp([2, -1, -2])))


def test_thresholds_leave_low_scores_out(spark):
    """Candidates that the rules always refuse get no threshold below their score."""
    r = random.Random(11)
    good = [f"card {r.choice(['4111 1111 1111 1111', '5500 0000 0000 0004'])} thanks" for _ in range(700)]
    bad = [f'token = "b7eb{r.randint(10**12, 10**13 - 1)}ff"' for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    found = by_id(pii.find(df, pii.train(df)))
    assert all(len(found[i].pii) == 1 for i in range(700)) and not any(found[i].pii for i in range(700, 760))


def test_other_spellings_are_found(spark):
    """National numbers and spelled-out addresses among rule matches and look-alikes; dates and order numbers stay."""
    r = random.Random(12)
    number = lambda n: "".join(str(r.randint(1, 9)) for _ in range(n))
    texts, planted, plain = [], {}, []
    for i in range(2400):
        name = "".join(r.choice("abcdefgh") for _ in range(6))
        texts.append(r.choice([f"Please call +1 ({number(3)}) {number(3)}-{number(4)} today", f"write to {name}@host{i % 7}.org soon",
                               f"order {number(9)} shipped", f"done on 20{r.randint(10, 24)}-0{r.randint(1, 9)}-1{r.randint(0, 9)} at noon"]))
        plain += [i] if re.match("order|done", texts[-1]) else []
    for i in range(0, 60, 2):
        for lead, span in (("Please call ", f"({number(3)}) {number(3)}-{number(4)}"), ("write to ", f"name{i}(at)host.org")):
            planted[len(texts)] = span
            texts.append(f"{lead}{span} today")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = by_id(pii.find(df, pii.train(df)))
    spans = lambda i: [texts[i][s.start:s.end] for s in found[i].pii]
    assert not any(spans(i) for i in plain)
    for lead in ("(", "n"):
        mine = [i for i, span in planted.items() if span.startswith(lead)]
        assert sum(spans(i) == [planted[i]] for i in mine) >= 0.9 * len(mine), [spans(i) for i in mine][:3]


def test_rewritten_matches():
    assert pii.respelled(0, "a@b.org", 3) == "a(at)b(dot)org" and pii.respelled(1, "1.2.3.4", 0) is None
    assert pii.respelled(3, "+1 (555) 010-1234", 0) == "(555) 010-1234" and pii.respelled(3, "+15550101234", 1) == "555-010-1234"
    assert (0, 3, 21) in pii.candidates("to name [at] host.org, or", True, False)
    pii.candidates("a (at) b." * 20_000, True, True)


def test_rare_kind_beside_a_frequent_one(spark, monkeypatch):
    """Thresholds come from all documents: a kind in few of them isn't crowded out of the sample."""
    monkeypatch.setattr(pii, "SAMPLE_CANDIDATES", 800)
    monkeypatch.setattr(pii, "SAMPLE_DOCS", 800, raising=False)
    r = random.Random(13)
    number = lambda n: "".join(str(r.randint(1, 9)) for _ in range(n))
    texts = ["build 1.2.3.400 of 10.20.3.999 done"] * 8000 + [f"Please call +1 ({number(3)}) {number(3)}-{number(4)} today" for _ in range(240)]
    planted = range(len(texts), len(texts) + 20)
    texts += [f"Please call ({number(3)}) {number(3)}-{number(4)} today" for _ in planted]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    trees = pii.train(df)
    assert trees.thresholds.keys() == {3}
    found = by_id(pii.find(df.where("doc_id >= 8000"), trees))
    assert all(len(found[i].pii) == 1 for i in planted)
    same = pii.train(df.repartition(5))
    assert same.thresholds == trees.thresholds


def test_least_level():
    assert pii.least_level([(9, 0, 1), (8, 1000, 1000), (7, 10, 60)]) == 8  # one wrong candidate on top
    assert pii.least_level([(9, 49, 49)]) == 9 and pii.least_level([(9, 48, 49)]) is None
    assert pii.least_level([(9, 40, 100), (8, 900, 900)]) is None
    assert pii.least_level([]) is None


@pytest.mark.parametrize("matches", [60, 1000])
def test_spellings_without_a_word_of_their_kind(spark, matches):
    """National numbers after any words, whatever the size of the corpus; what is refuted stays."""
    r = random.Random(14)
    number = lambda n: "".join(str(r.randint(1, 9)) for _ in range(n))
    lead = lambda: " ".join(r.choice(["reach", "me", "on", "again", "soon", "or", "then"]) for _ in range(3))
    texts = [f"{lead()} +44 20 {number(4)} {number(4)} {lead()}" for _ in range(matches)]
    clean = range(len(texts), len(texts) + 200)
    for i in clean:
        texts.append(r.choice([f"{lead()} {number(9)} {lead()}", f"{lead()} 20{r.randint(10, 24)}-0{r.randint(1, 9)}-1{r.randint(0, 9)} {lead()}",
                               f'token = "b7eb{number(9)}ff"']))
    planted = range(len(texts), len(texts) + 50)
    texts += [f"{lead()} 020 {number(4)} {number(4)} {lead()}" for _ in planted]
    found = by_id(pii.find(df := spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), pii.train(df)))
    assert sum([texts[i][s.start:s.end].startswith("020 ") for s in found[i].pii] == [True] for i in planted) >= 45
    assert not any(found[i].pii for i in clean)
