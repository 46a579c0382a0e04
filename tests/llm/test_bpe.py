"""Rank-array BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from llm_helpers import by_id, document, tables  # noqa: F401

from chainmetrics.llm import bpe, queries

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(queries.byte_bpe_file())


def texts():
    r = random.Random(2)
    parts = [*"abst'relvdm  \n\t09.,!é日😀²", "<|endoftext|>", "'s", "'ll", "'ve", "the ", "　", " ", "<|endof"]
    out = ["".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(400)]
    out += ["".join(chr(r.choice([r.randint(32, 0x2FFF), r.randint(0x10000, 0x1FFFF)])) for _ in range(20)) for _ in range(200)]
    return out + ["", " ", "\n\n", "a" * 5000, "=" * 3000 + " " * 500, "it's  \n's", "<|endoftext|><|endoftext|>", "Don't"]


def test_ids_and_round_trip_equal_the_library(spark, tables, library):
    rows = [document(i, t) for i, t in enumerate(texts())] + [document(9000, None)]
    got = by_id(queries.QUERIES["op4_bpe"](spark, tables(documents=rows)))
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids), repr(text)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), repr(text)
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_long_words_take_the_same_merges():
    with open(queries.byte_bpe_file(), encoding="utf-8") as f:
        vocab = bpe.Vocabulary(f.read())
    r = random.Random(3)
    for _ in range(50):
        word = np.frombuffer("".join(r.choice(["th", "e", "in", "z", "qu"]) for _ in range(30))[:bpe.SHORT].encode(), np.uint8)
        ids, counts = vocab.merge_rows(vocab.byte_ids[word][None])
        assert ids[0, :counts[0]].tolist() == vocab.merge_long(word)


def test_operator_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a b", "k", 3), (1, "a b", "k", 3), (2, None, None, None)], "doc_id long, text string, extra string, token_ids int")
    out = bpe.decode(bpe.encode(df, queries.byte_bpe_file()), queries.byte_bpe_file())
    assert out.columns == ["doc_id", "text", "extra", "token_ids", "decoded"]
    assert sorted((r.doc_id, r.decoded, len(r.token_ids)) for r in out.collect()) == [(1, "a b", 2), (1, "a b", 2), (2, "", 0)]
    assert bpe.encode(df.limit(0), queries.byte_bpe_file()).count() == 0
    ids = spark.createDataFrame([(1, None), (2, [0])], "doc_id long, token_ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(ids, queries.byte_bpe_file()).collect()} == {1: None, 2: "!"}
