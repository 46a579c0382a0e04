"""Personal data: rule matches, and candidates scored by gradient-boosted trees.

* Rules find e-mail addresses, IPv4 addresses, payment cards (Luhn) and telephone
  numbers; their matches ("base" spans) are always reported.
* High-recall generators propose further, overlapping spans: tokens around an ``@`` or
  an ``(at)``, spelled-out addresses, dotted numbers, digit chains of 7 to 19 digits (as
  telephone and as card).
* Boosted trees (MLlib ``GBTClassifier``) judge candidates by format and context; what the
  rules check (Luhn, octets, top-level domain, the leading plus) is not a feature. They learn
  from what the rules can't see (``examples``), on about ``SAMPLE_CANDIDATES`` candidates
  of one half of the documents, an equal share for each kind: right are rule matches written in
  another way in the same place (national numbers, ``name(at)host.org``, cards with other
  separators); wrong are candidates with evidence against them in themselves (``refuted``).
  All others are unlabelled; no list of words around a candidate plays a part.
  An IPv4 address has no other spelling, so that kind adds nothing.
* Thresholds are calibrated per kind on all documents of the half that the trees haven't
  seen, counted by kind and score on the executors: the least score from which ``PRECISION`` of the candidates are right, and
  ``LOCAL_PRECISION`` at every score on the way. Where none reaches that, the kind adds
  nothing. Of overlapping winners the better stays, and none may overlap a base span.

Finding and redacting are row-local (one ``mapInArrow`` pass over whole texts); the
trees, some hundred numbers, are broadcast.

Defined results: null text is empty and has no spans; very long texts are searched whole, in
linear time; offsets are code points; repeated
rows are treated alike; without documents or without both kinds of candidates only the
rules apply; columns named like the outputs are replaced, others kept.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainmetrics.llm import textbuf as tb
from chainmetrics.session import materialize

KINDS = ("email", "ip", "card", "phone")
#: Candidates the trees learn from: as many places for each kind, right and wrong.
SAMPLE_CANDIDATES = 20_000
#: Steps of the score in which thresholds are set.
LEVELS = 1000
PRECISION = 0.995
#: The same for the candidates of one score alone.
LOCAL_PRECISION = 0.95
#: So many candidates of consecutive levels are judged together before they can end the search.
JUDGED_TOGETHER = 50
TREES, DEPTH = 10, 3

# Every pattern is linear: runs are taken possessively, so no start is tried twice.
_RUN = re.compile(r"[A-Za-z0-9._%+-]++@?")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DOTTED = re.compile(r"[0-9]++(?:(?:\.[0-9]++){3})?+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_CHAIN = re.compile(r"\+?\(?[0-9](?:[ ().-]{0,2}[0-9])*+")
_TOKEN = re.compile(r"\S++")
_AT = re.compile(r"@|\(at\)|\[at\]", re.I)
_AT_RUN = re.compile(r"[A-Za-z0-9._%+-]++(?P<at> ?[(\[]at[)\]] ?)?+", re.I)
_AT_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:(?:\.| ?[(\[]dot[)\]] ?)[A-Za-z0-9-]++)++", re.I)
_BRACKET_AT, _BRACKET_DOT = re.compile(r" ?[(\[]at[)\]] ?", re.I), re.compile(r" ?[(\[]dot[)\]] ?", re.I)
#: What a chain of digits is if not a telephone number: a date (and time), a dotted quad.
_NO_PHONE = re.compile(r"(?:19|20)[0-9]{2}([-./ ])[0-9]{1,2}\1[0-9]{1,2}(?![0-9])|[0-9]{1,2}([-./ ])[0-9]{1,2}\2(?:19|20)[0-9]{2}(?![0-9])"
                       r"|[0-9]+(?:\.[0-9]+){3}$")
_PREFIX = re.compile(r"\+(?:1(?=[0-9]{10}$)|[0-9]{2}(?=[0-9]{7,}$)|[0-9]{1,3}(?![0-9]))[ .-]*")

def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def rule_spans(text: str, at: bool, digit: bool) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the rule matches, by kind and start. ``at``, ``digit``: whether the text holds any."""
    out = []
    if at:
        end = 0
        for m in _RUN.finditer(text):
            if text[m.end() - 1] == "@":
                start, d = max(m.start(), end), _DOMAIN.match(text, m.end())
                if d and start < m.end() - 1:
                    out.append((0, start, end := d.end()))
    if digit:
        for m in _DOTTED.finditer(text):
            if "." in m[0] and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((1, m.start(), m.end()))
        for m in _DIGITS.finditer(text):
            digits = re.sub("[ -]", "", m[0]) if m.end() - m.start() <= 40 else ""
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def candidates(text: str, at: bool, digit: bool) -> list[tuple[int, int, int]]:
    """(kind, start, end) proposed with high recall; spans may overlap."""
    out = []
    if at:
        for m in _TOKEN.finditer(text):
            if _AT.search(m[0]):
                s, e = m.span()
                while s < e and not text[s].isalnum():
                    s += 1
                while s < e and not text[e - 1].isalnum():
                    e -= 1
                if e - s >= 5:
                    out.append((0, s, e))
        if _BRACKET_AT.search(text):
            tokens = set(out)
            for m in _AT_RUN.finditer(text):
                d = _AT_DOMAIN.match(text, m.end()) if m["at"] else None
                if d and (0, m.start(), d.end()) not in tokens:
                    out.append((0, m.start(), d.end()))
    if digit:
        for m in _CHAIN.finditer(text):
            digits = sum(c.isdigit() for c in m[0])
            if m[0].count(".") == 3 and digits <= 15:
                out.append((1, m.start(), m.end()))
            if 7 <= digits <= 15:
                out.append((3, m.start(), m.end()))
            if 12 <= digits <= 19:
                out.append((2, m.start(), m.end()))
    return out


def _char(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    span, before, after = text[start:end], text[max(0, start - 30):start], text[end:end + 30]
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    digits = sum(groups)
    return [
        kind, len(span), digits, len(groups), max(groups, default=0), groups[0] if groups else 0, groups[-1] if groups else 0,
        len(set(c for c in span if c.isdigit())), span.count(" "), span.count("-"), span.count("."),
        span.count("(") + span.count(")"), sum(c.isalpha() for c in span), sum(c.isupper() for c in span),
        _char(before[-1:]), _char(after[:1]), sum(c.isdigit() for c in before), sum(c.isdigit() for c in after),
        sum(not c.isalnum() and not c.isspace() for c in before + after), "\n" in before + after,
    ]


N_FEATURES = 20


def respelled(kind: int, span: str, pick: int) -> str | None:
    """A rule match in a spelling that the rules don't know, one of several by ``pick``; None where there is none."""
    if kind == 0:
        name, _, domain = span.rpartition("@")
        at, dot = (("(at)", "."), ("[at]", "."), (" (at) ", "."), ("(at)", "(dot)"), (" [at] ", " [dot] "), ("[at]", "[dot]"))[pick % 6]
        return name + at + domain.replace(".", dot)
    if kind == 2:
        digits = re.sub("[^0-9]", "", span)
        sep = (".", "  ", "--", ". ")[pick % 4]
        return sep.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    if kind == 3:
        prefix = _PREFIX.match(span)
        national = span[prefix.end():] if prefix else ""
        groups = re.findall("[0-9]+", national)
        digits = "".join(groups)
        if not 7 <= len(digits) <= 15:
            return None
        if len(groups) < 2 or len(groups[0]) > 5:
            groups = [digits[:3], digits[3:6], digits[6:]]
        rest = groups[1:]
        return (national, "-".join(groups), ".".join(groups), " ".join(groups), f"({groups[0]}) {'-'.join(rest)}",
                f"({groups[0]}) {' '.join(rest)}", "0" + " ".join(groups), span[1:])[pick % 8]
    return None


def refuted(text: str, kind: int, start: int, end: int) -> bool:
    """Whether something in the candidate itself speaks against the kind: evidence to learn from.

    A part of a longer name or number, a date or dotted quad as telephone number, digits that
    fail the card checksum, a run of digits without any grouping, an address that isn't
    one when spelled plainly. What stands around it (a word like "tel") doesn't count."""
    span = text[start:end]
    if kind == 0:
        plain = _BRACKET_DOT.sub(".", _BRACKET_AT.sub("@", span))
        return "@" in span or not rule_spans(plain, True, False)
    if kind == 1 or re.match(r"[\w#$€£]", text[start - 1:start]) or re.match(r"\w", text[end:end + 1]):
        return True
    if kind == 2:
        return not luhn(re.sub("[^0-9]", "", span))
    return span.isdigit() or bool(_NO_PHONE.match(span))


def examples(text: str, at: bool, digit: bool) -> list[tuple[float, list[float]]]:
    """(label, features) of the candidates to learn from and to be judged by: what could be added to the base spans.

    Right are rule matches in another spelling, wrong are refuted candidates; all others stay unlabelled."""
    out, base = [], rule_spans(text, at, digit)
    for kind, start, end in base:
        new = respelled(kind, text[start:end], zlib.crc32(text[max(0, start - 30):end].encode("utf-8", "replace")))
        if new:
            # Features look 30 characters around, and so this much of the text is enough.
            before, after = text[max(0, start - 60):start], text[end:end + 60]
            near, s, e = before + new + after, len(before), len(before) + len(new)
            for k, a, b in candidates(near, True, True):
                if (k, a, b) == (kind, s, e):
                    out.append((1.0, features(near, k, a, b)))
                elif k != kind and s <= a and b <= e:
                    out.append((0.0, features(near, k, a, b)))
    inside = np.zeros(len(text) + 1, np.int64)
    for _, s, e in base:
        inside[s + 1:e + 1] = 1
    inside = np.cumsum(inside)  # characters of rule matches before each place
    for k, s, e in candidates(text, at, digit):
        if inside[s] == inside[e] and refuted(text, k, s, e):
            out.append((0.0, features(text, k, s, e)))
    return out


class Trees:
    """Fitted trees as arrays, and the threshold (a level of the score) of each kind."""

    def __init__(self, roots: list, weights: list[float], thresholds: dict[int, int]):
        self.roots, self.weights, self.thresholds = roots, weights, thresholds

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for root, w in zip(self.roots, self.weights):
            total += w * self._walk(root, x)
        return 1 / (1 + np.exp(-2 * total))

    def _walk(self, node, x: np.ndarray) -> np.ndarray:
        if not isinstance(node, tuple):
            return np.full(len(x), node)
        feature, cut, left, right = node
        return np.where(x[:, feature] <= cut, self._walk(left, x), self._walk(right, x))


def _exported(node):
    """A fitted tree as nested tuples (feature, threshold, left, right), leaves as numbers."""
    if node.numDescendants() == 0:
        return float(node.prediction())
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _exported(node.leftChild()), _exported(node.rightChild())


def _flags(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts, and which of them hold an at sign or an ASCII digit."""
    buf, offs = tb.string_buffers(column)
    count = lambda hit: np.diff(np.concatenate(([0], np.cumsum(hit)))[offs]) > 0
    # Spelled-out addresses bring their bracket.
    at = count((buf == 64) | (buf == 40) | (buf == 91))
    digit = count((buf >= 48) & (buf <= 57))
    return column, at, digit


def _text(column: pa.Array, i: int) -> str:
    return column[i].as_py() or ""


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Trees | None:
    """Trees from a bounded sample of one half's candidates, thresholds from all of the other's; None if there is nothing to learn."""
    # Here and not above: workers that only find spans needn't load the library.
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    key = F.xxhash64(F.col(id_col), F.lit(9))
    halves = docs.select(F.col(text_col).alias("text"), key.alias("key"))
    seen, unseen = (halves.where(F.pmod("key", F.lit(2)) == h) for h in (0, 1))
    met = {(r["kind"], r["label"]): r["n"] for r in _counted(seen, None).groupBy("kind", "label").agg(F.sum("n").alias("n")).collect()}
    if len({label for _, label in met}) < 2:
        return None
    # Each kind has its own places, so that a frequent one leaves the others theirs.
    rates = {k: min(1.0, SAMPLE_CANDIDATES / (2 * len(KINDS)) / n) for k, n in met.items()}

    def run(batch):
        texts, at, digit = _flags(batch.column(0))
        rows, label = [], []
        for i in np.flatnonzero(at | digit).tolist():
            for n, (right, x) in enumerate(examples(_text(texts, i), at[i], digit[i])):
                if zlib.crc32(f"{batch.column(1)[i].as_py()} {n}".encode()) < rates.get((int(x[0]), right), 0) * 2**32:
                    rows.append(x)
                    label.append(right)
        return {"x": pa.array(rows, pa.list_(pa.float64())), "label": pa.array(label, pa.float64())}

    rows = materialize(tb.map_arrow(seen, run, [T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("label", T.DoubleType())]))
    if rows.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=9, stepSize=0.3).fit(
        rows.select(array_to_vector("x").alias("features"), "label").coalesce(2))
    fitted = Trees([_exported(t._call_java("rootNode")) for t in model.trees], list(model.treeWeights), {})
    # At most LEVELS + 1 rows per kind reach the driver, whatever the size of the corpus.
    judged = (_counted(unseen, docs.sparkSession.sparkContext.broadcast(fitted)).groupBy("kind", "level")
              .agg(F.sum(F.col("n") * F.col("label")).alias("good"), F.sum("n").alias("n")).orderBy(F.desc("level")).collect())
    for kind in range(len(KINDS)):
        level = least_level([(r["level"], r["good"], r["n"]) for r in judged if r["kind"] == kind])
        if level is not None:
            fitted.thresholds[kind] = level
    return fitted


def _counted(halves: DataFrame, shared) -> DataFrame:
    """kind, label, level and n: the examples of all texts, counted batch by batch; level 0 without trees."""

    def run(batch):
        texts, at, digit = _flags(batch.column(0))
        found = [e for i in np.flatnonzero(at | digit).tolist() for e in examples(_text(texts, i), at[i], digit[i])]
        x = np.array([f for _, f in found], float).reshape(-1, N_FEATURES)
        level = levels(shared.value.score(x)) if shared else np.zeros(len(x), np.int64)
        rows, n = np.unique(np.stack([x[:, 0].astype(np.int64), np.array([r for r, _ in found], np.int64), level]), axis=1, return_counts=True)
        return {"kind": pa.array(rows[0]), "label": pa.array(rows[1].astype(float)), "level": pa.array(rows[2]), "n": pa.array(n.astype(np.int64))}

    return tb.map_arrow(halves, run, [T.StructField("kind", T.LongType()), T.StructField("label", T.DoubleType()),
                                      T.StructField("level", T.LongType()), T.StructField("n", T.LongType())])


def levels(scores: np.ndarray) -> np.ndarray:
    return np.floor(scores * LEVELS).astype(np.int64)


def least_level(found: list[tuple[int, float, int]]) -> int | None:
    """The level down to which candidates are added, from (level, right, all) by falling level.

    A level is taken while all candidates down to it are right often enough, and those of its
    stretch, too. A failing stretch ends the search once it holds ``JUDGED_TOGETHER``
    candidates: on a large corpus every rare level is met, and one wrong candidate alone says nothing."""
    out, good, seen, right, total = None, 0, 0, 0, 0
    for level, r, n in found:
        good, seen, right, total = good + r, seen + n, right + r, total + n
        if good >= PRECISION * seen and right >= LOCAL_PRECISION * total:
            out = level
            if total >= JUDGED_TOGETHER:
                right = total = 0
        elif total >= JUDGED_TOGETHER:
            break
    return out


def all_spans(text: str, at: bool, digit: bool, trees: Trees | None) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, base) of every reported span, by kind and start."""
    base = rule_spans(text, at, digit)
    out = [(*s, True) for s in base]
    if trees and trees.thresholds:
        more = [c for c in candidates(text, at, digit) if c[0] in trees.thresholds
                and not any(s < c[2] and c[1] < e for _, s, e in base)]
        if more:
            scores = trees.score(np.array([features(text, *c) for c in more], float))
            level = levels(scores)
            taken: list[tuple[int, int]] = []
            for i in np.argsort(-scores, kind="stable"):
                k, s, e = more[i]
                if level[i] >= trees.thresholds[k] and not any(a < e and s < b for a, b in taken):
                    taken.append((s, e))
                    out.append((k, s, e, False))
    return sorted(out)


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                     T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType())])


def find(df: DataFrame, trees: Trees | None, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """Append the spans of every whole text, ordered by kind and start."""
    shared = df.sparkSession.sparkContext.broadcast(trees)

    def run(column):
        texts, at, digit = _flags(column)
        out = [[]] * len(texts)
        for i in np.flatnonzero(at | digit).tolist():
            out[i] = [{"kind": KINDS[k], "start": s, "end": e, "base": b} for k, s, e, b in all_spans(_text(texts, i), at[i], digit[i], shared.value)]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        return {out_col: pa.array(out, kind)}

    return tb.append_columns(df, text_col, run, [T.StructField(out_col, T.ArrayType(SPAN))])


def mask(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    """The text with each stretch of overlapping spans replaced by the kind of its first."""
    out, at = [], 0
    for k, s, e, _ in sorted(spans, key=lambda x: (x[1], x[2])):
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact(df: DataFrame, trees: Trees | None, text_col: str = "text") -> DataFrame:
    """Replace every span of the text column by its kind in brackets; null stays null, columns keep their order."""
    shared = df.sparkSession.sparkContext.broadcast(trees)
    new = max(["_masked", *(f"{c}_" for c in df.columns)], key=len)  # a name that no column has

    def run(column):
        texts, at, digit = _flags(column)
        out = texts.to_pylist()
        for i in np.flatnonzero(at | digit).tolist():
            spans = all_spans(out[i] or "", at[i], digit[i], shared.value)
            if spans:
                out[i] = mask(out[i], spans)
        return {new: pa.array(out, pa.string())}

    done = tb.append_columns(df, text_col, run, [T.StructField(new, T.StringType())])
    return done.select(*[F.col(f"`{new}`").alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns])
