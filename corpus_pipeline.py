"""Corpus pipeline over ``documents``: language ID, near-duplicates, contamination, PII, BPE.

``STAGES`` lists (name, function) pairs; each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next one's docs. All
but the last return the columns of ``documents``. Extra input columns are dropped at the
first stage, missing ones are an error. Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainmetrics.llm import bpe, decontam, langid, neardup, pii, queries
from chainmetrics.session import scratch_path, ship_package
from chainmetrics.sources.tables import read_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts that have a language; ``lang`` is set to it.

    Null and letterless texts (``und``) go, no others. The model learns from the labelled texts outside of the held-out quarter."""
    found = langid.identify(docs.select(*COLUMNS))
    return (found.where(F.col("lang_pred") != "und")
            .select("doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document (the smallest id) of each near-duplicate group; of rows that
    share an id the one of the least hash stays, whatever their order."""
    kept = neardup.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_id")).distinct()
    same = docs.select(*COLUMNS).join(kept, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    # Rows without an id are no copies of one another by that.
    one = same.where("doc_id is not null").groupBy("doc_id").agg(F.min_by(F.struct(*COLUMNS[1:]), F.xxhash64(*COLUMNS)).alias("row"))
    return same.where("doc_id is null").unionByName(one.select("doc_id", "row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which at least one word in twenty lies in a benchmark passage."""
    found = decontam.find_contamination(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))
    return found.where(~decontam.contaminated()).select(*COLUMNS)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind in brackets; every document stays."""
    masked = pii.redact(docs.select(*COLUMNS), pii.train(docs))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, digested like the BPE query: the round trip is checked there."""
    return bpe.round_trip(docs.select("doc_id", "text", "lang", "source"), queries.byte_bpe_file()).drop("text")


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", redact_pii),
    ("bpe", tokenize),
]

#: No stage but contamination can be expressed in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; intermediate tables go to the shared checkpoint folder."""
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
