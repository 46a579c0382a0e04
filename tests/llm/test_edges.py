"""Every query on empty tables, on rows of nulls, on repeated rows and with extra columns."""

import pytest
from llm_helpers import document, tables  # noqa: F401
from pyspark.sql import functions as F

from chainmetrics.llm import collocations, decontam, fim, langid, lattice, mixing, neardup, pii, queries, sharding, suffixes, topk

OPS = sorted(q for q in queries.QUERIES if q.startswith("op"))


@pytest.mark.parametrize("name", OPS)
def test_empty_tables(spark, tables, name):
    folder = tables(documents=[], benchmark=[], embeddings=[], conversations=[])
    assert queries.QUERIES[name](spark, folder).count() == (1 if name.startswith("op10") else 0)


@pytest.mark.parametrize("name", OPS)
def test_nulls_and_repeated_rows(spark, tables, name):
    docs = [(None,) * 5, (None,) * 5, (1, None, None, None, None), document(2, "same words in both rows here"), document(2, "same words in both rows here"),
            document(3, ""), document(4, "x" * 20_000 + " end"), document(100, "0" * 300)]
    folder = tables(documents=docs, benchmark=[(None, None), (1, None), (2, "same words in both rows here"), (2, "same words in both rows here")],
                    embeddings=[(None, None, None), (100, [1.0, 2.0], 0), (100, [1.0, 2.0], 0), (1, [None, 1.0], 0), (2, [1.0, 1.0], None)],
                    conversations=[(None,) * 4, (None,) * 4, (1, None, None, None), (1, 1, "user", "x"), (1, 1, "user", "x")])
    got = queries.QUERIES[name](spark, folder).count()
    assert got == {"op6_topk": 1, "op10_chat": 3, "op12_collocations": 0}.get(name, len(docs))


def test_extra_columns_with_clashing_names(spark):
    names = ("id", "doc", "start", "n", "b", "h", "key", "comp", "kept", "size", "shard", "score", "train", "v", "q", "_h", "_id", "_n", "_t",
             "_masked", "sketch", "digest", "spans", "items", "held_out", "lang_pred", "a", "page", "x")
    df = spark.createDataFrame([(i, f"some words {i % 3} and more of them to read", "en") for i in range(12)], "doc_id long, text string, lang string")
    df = df.select("*", *[F.lit("extra").alias(c) for c in names])
    bench = spark.createDataFrame([(1, "words 1 and more of them", "k")], "item_id long, text string, words string")
    assert decontam.find_contamination(df, bench).where("n_hit > 0").count() == 4
    assert suffixes.remove_repeats(df).count() == 12
    assert neardup.near_duplicates(df).where("kept").count() == 3
    assert langid.identify(df).where("lang_pred = 'en'").count() == 12
    assert lattice.score(df, F.lit(True), queries.byte_bpe_file(), F.lit(1)).count() == 12
    assert sharding.assign(df, [1.0] * 3).count() == 12
    assert pii.redact(df, None).columns == df.columns
    assert fim.transform(df).where("form <> 'plain'").count() == 12
    assert {r.phrase for r in collocations.mine(df).collect()} == {"some words", "and more of", "more of them", "of them to", "them to read"}
    assert mixing.mix(df.withColumn("source", F.lit("s"))).where("target = 108").count() == 12
    vectors = df.select("*", F.array(F.lit(1.0), F.col("doc_id").cast("double")).alias("embedding"))
    assert topk.top_k(vectors, F.col("doc_id") == 0, k=3, id_col="doc_id").count() == 3
