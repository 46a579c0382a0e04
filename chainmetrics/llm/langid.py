"""Language identification with a string kernel.

Kernel: blended-spectrum presence. A text is the set of its byte 1-, 2- and 3-grams
(ASCII letters folded to lower case, all bytes folded to a 64-letter alphabet, so the
grams have a fixed index of 266,304 columns); ``k(x, z) = |x & z| / sqrt(|x| |z|)``.
Nyström: landmarks z_1..z_m from the training sample give the features
``K_mm^-1/2 k_m(x)``; one ridge regression per language (one versus rest) is fitted on
them. Scoring multiplies the presence matrix of a batch with the landmarks' presence
and the coefficients; as both are linear in presence, the two products are folded
into one matrix of grams x languages beforehand.

The sample is bounded (``SAMPLE`` texts in all, the smallest hashes of each
language); it alone reaches the driver. The folded matrix is broadcast: its size
depends on the alphabet and the number of languages, not on the data. Scoring covers
every whole text, row-local in one ``mapInArrow`` pass.

Defined results: text that is null or has no letter is ``und`` with score 0; without
any training text everything is ``und``; equal scores go to the language first in
order; rows with null language don't train; repeated rows are predicted alike; input
columns named like the outputs are replaced, others kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from chainmetrics.llm import textbuf as tb

SAMPLE = 1600
LANDMARKS = 160
RIDGE = 0.003
SHARPNESS = 4.0
#: Beginning of the columns of the 1-, 2- and 3-grams; the last is their number.
BASES = (0, 64, 64 + 64**2, 64 + 64**2 + 64**3)

ALPHABET = np.full(256, 26, np.uint32)  # letters 0-25, other ASCII 26-29, bytes from 0x80 on 30-63
ALPHABET[97:123] = np.arange(26)
ALPHABET[65:91] = np.arange(26)
ALPHABET[[9, 10, 11, 12, 13, 32]] = 27
ALPHABET[48:58] = 28
ALPHABET[39] = 29
ALPHABET[128:] = 30 + np.arange(128) % 34
ASCII_LETTER = tb.byte_class(lambda b: 65 <= b <= 90 or 97 <= b <= 122)


def presence(codes: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Sorted columns of the distinct grams of one text; ``seen`` is an all-false work array."""
    seen[codes] = True
    if len(codes) > 1:
        two = codes[:-1] * 64 + codes[1:]
        seen[two + BASES[1]] = True
        if len(codes) > 2:
            seen[two[:-1] * 64 + codes[2:] + BASES[2]] = True
    at = np.flatnonzero(seen)
    seen[at] = False
    return at


def has_letter(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Which rows hold a letter of any script."""
    total = np.concatenate(([0], np.cumsum(ASCII_LETTER[buf])))
    out = np.diff(total[offs]) > 0
    for i in np.flatnonzero(~out & (np.diff(offs) > 0)):
        out[i] = any(c.isalpha() for c in buf[offs[i]:offs[i + 1]].tobytes().decode())
    return out


class Model:
    """Languages and the folded matrix (grams x languages)."""

    def __init__(self, labels: list[str], sets: list[np.ndarray]):
        self.languages = sorted(set(labels))
        if not labels:
            return
        y = np.where(np.array(labels)[:, None] == np.array(self.languages), 1.0, -1.0)
        # Landmarks: the same number of the first texts of each language.
        share = max(1, LANDMARKS // len(self.languages))
        marks = np.concatenate([np.flatnonzero(y[:, c] > 0)[:share] for c in range(len(self.languages))])
        columns = np.unique(np.concatenate([sets[i] for i in marks]))
        place = np.full(BASES[3], -1)
        place[columns] = np.arange(len(columns))
        z = np.zeros((len(columns), len(marks)), np.float32)
        for j, i in enumerate(marks):
            z[place[sets[i]], j] = 1 / np.sqrt(len(sets[i]))
        k = np.empty((len(sets), len(marks)))
        for i, s in enumerate(sets):
            at = place[s]
            k[i] = z[at[at >= 0]].sum(0) / np.sqrt(len(s))
        value, vector = np.linalg.eigh(k[marks])
        keep = value > 1e-6 * value.max()
        root = vector[:, keep] / np.sqrt(value[keep])
        phi = np.hstack((k @ root, np.ones((len(sets), 1))))
        penalty = RIDGE * len(sets) * np.eye(phi.shape[1])
        penalty[-1, -1] = 1e-9
        # Every language weighs the same, however many texts it has.
        weight = (1 / np.maximum(1, (y > 0).sum(0)))[y.argmax(1)]
        weight *= len(sets) / weight.sum()
        beta = np.linalg.solve(phi.T @ (phi * weight[:, None]) + penalty, phi.T @ (y * weight[:, None]))
        self.bias = beta[-1]
        self.matrix = np.zeros((BASES[3], len(self.languages)), np.float32)
        self.matrix[columns] = z @ (root @ beta[:-1])

    def predict(self, buf: np.ndarray, offs: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(offs) - 1
        pred, score = ["und"] * n, np.zeros(n)
        if not self.languages:
            return pred, score
        letters = np.flatnonzero(has_letter(buf, offs))
        seen, codes = np.zeros(BASES[3], bool), ALPHABET[buf]
        margins = np.zeros((len(letters), len(self.languages)))
        for r, i in enumerate(letters):
            at = presence(codes[offs[i]:offs[i + 1]], seen)
            margins[r] = self.matrix[at].sum(0) / np.sqrt(len(at)) + self.bias
        soft = np.exp(SHARPNESS * (margins - margins.max(1, keepdims=True))) if len(letters) else margins
        soft /= soft.sum(1, keepdims=True)
        for i, c, s in zip(letters.tolist(), soft.argmax(1).tolist(), soft.max(1).tolist()):
            pred[i], score[i] = self.languages[c], s
        return pred, score


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` of the labelled texts, evenly over the languages."""
    usable = labelled.select(id_col, text_col, lang_col).where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    key = F.xxhash64(F.col(id_col), F.lit(7))
    n_langs = usable.select(lang_col).distinct().count()
    if not n_langs:
        return Model([], [])
    first = Window.partitionBy(lang_col).orderBy("_h", id_col)
    chosen = (usable.select(id_col, lang_col, key.alias("_h"))
              .withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= max(2, sample // n_langs))
              .select(F.col(id_col).alias("_id")).distinct())
    # At most ``sample`` ids: the broadcast is bounded by that parameter.
    texts = (usable.join(F.broadcast(chosen), F.col(id_col).eqNullSafe(F.col("_id")), "left_semi")
             .dropDuplicates([id_col]).select(id_col, lang_col, F.col(text_col).alias("_t")))

    def sets(batch):
        buf, offs = tb.string_buffers(batch.column(2))
        codes, seen = ALPHABET[buf], np.zeros(BASES[3], bool)
        return {"id": batch.column(0), "lang": batch.column(1),
                "grams": pa.array([presence(codes[a:b], seen).astype(np.int32).tobytes() for a, b in zip(offs, offs[1:])], pa.binary())}

    fields = [T.StructField("id", labelled.schema[id_col].dataType), T.StructField("lang", T.StringType()), T.StructField("grams", T.BinaryType())]
    rows = tb.map_arrow(texts, sets, fields).toArrow().to_pylist()
    rows.sort(key=lambda r: (r["lang"], r["id"] is None, r["id"] or 0))
    return Model([r["lang"] for r in rows], [np.frombuffer(r["grams"], np.int32) for r in rows])


def predict(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Append lang_pred and score (0 to 1) to every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(column):
        buf, offs = tb.string_buffers(column)
        pred, score = [], []
        for _, _, b, o in tb.slices(buf, offs):
            p, s = shared.value.predict(b, o)
            pred += p
            score.append(s)
        return {"lang_pred": pa.array(pred, pa.string()), "score": pa.array(np.concatenate(score) if score else [], pa.float64())}

    return tb.append_columns(df, text_col, run, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def remainder(id_col: str, n: int):
    """crc32 of the id as text, modulo n (null counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the rows outside of the held-out quarter, predict all; appends held_out too."""
    held = remainder(id_col, 4) == 2
    model = train(df.where(~held), id_col, text_col, lang_col)
    return predict(df.withColumn("held_out", held), model, text_col)
