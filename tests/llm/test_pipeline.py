"""The pipeline against its stages in plain Python, and the guard of the entry module."""

import hashlib
import os
import re
import subprocess
import sys

import corpus_pipeline
from llm_helpers import by_id, document, SF_CHECK, tables  # noqa: F401
from pyspark.sql import functions as F
from test_decontam import brute as hits
from test_neardup import brute as groups
from test_pii import brute as personal

from chainmetrics.llm import pii, queries

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_run_equals_plain_stages(spark, tables):
    import tokenizers
    base = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").where("doc_id < 150").collect()]
    bench = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/benchmark.parquet").collect()]
    odd = [(2000, None, "en"), (2001, "", None), (2002, "12 34 !!", "en"), (2003, base[3][1], "en"), (2004, bench[0][1], "en"),
           (2005, base[5][1] + " write to a.b@c.example.org or +1 (555) 010-2233", base[5][2]), (2006, base[9][1], None)]
    rows = base + odd
    folder = tables(documents=[document(i, t, lang) for i, t, lang in rows], benchmark=bench)
    got = by_id(corpus_pipeline.run(spark, folder))
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "pii", "bpe"]

    left = [(i, t) for i, t, _ in rows if t and any(c.isalpha() for c in t)]
    comp = groups(left)
    left = [(i, t) for i, t in left if comp[i][1] == i]
    found = hits(left, bench)
    left = [(i, t) for i, t in left if not (found[i][1] and 20 * found[i][1] >= found[i][0])]
    library = tokenizers.Tokenizer.from_file(queries.byte_bpe_file())
    assert set(got) == {i for i, _ in left} and 2002 not in got and 2004 not in got
    for i, text in left:
        masked = pii.mask(text, [(*s, True) for s in personal(text)])
        if not re.search(r"\d{7}|@", re.sub(r"\[[A-Z]+\]", "", masked)):
            assert got[i].decoded_sha256 == hashlib.sha256(masked.encode()).hexdigest()
            assert got[i].n_tokens == len(library.encode(masked, add_special_tokens=False).ids)


def test_stages_keep_the_columns(spark, tables):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").where("doc_id < 40")
    extra = docs.withColumn("score", F.lit("clash")).withColumn("kept", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, extra, SF_CHECK).columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF_CHECK).count() == 0, name
    assert corpus_pipeline.tokenize(spark, docs.limit(0), SF_CHECK).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 2 + [(3, "abc def", None, None, None)] * 2, docs.schema)
    # Without a labelled text no language is known; rows without an id are no copies; one of two equal ids stays.
    left = {"language_id": [], "near_dedup": [None, None, 3], "decontamination": [None, None, 3, 3], "pii": [None, None, 3, 3], "bpe": [None, None, 3, 3]}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, nulls, SF_CHECK).collect()
        assert sorted((r.doc_id for r in got), key=lambda i: (i is not None, i)) == left[name], name
        if name != "bpe":
            assert {(r.doc_id, r.text) for r in got} == {(i, None if i is None else "abc def") for i in left[name]}, name


def test_one_row_of_an_id_stays_whatever_the_order(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(5, f"text number {i} of the same id", "en", "s", 1) for i in range(6)] + [(9, "another one here that stays", "en", "s", 1)]
    got = []
    for parts, data in ((1, rows), (3, rows[::-1]), (5, rows)):
        out = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(data, schema).repartition(parts), SF_CHECK)
        assert out.columns == schema.replace(" long", "").replace(" string", "").split(", ")
        got.append(sorted(tuple(r) for r in out.collect()))
    assert got[0] == got[1] == got[2] and [r[0] for r in got[0]] == [5, 9]


def test_entry_works_without_the_subpackage(tmp_path):
    """A copy of the repository without the subpackage and the pipeline still imports."""
    import shutil
    for name in ("__spark_entry__.py", "chainmetrics"):
        src = os.path.join(ROOT, name)
        if os.path.isdir(src):
            shutil.copytree(src, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(src, tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), sum(q.startswith('op') for q in e.queries()))"],
                         cwd=tmp_path, capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.returncode == 0, out.stderr
    assert out.stdout.split()[1] == "0" and int(out.stdout.split()[0]) >= 60


def test_all_queries_are_registered():
    import __spark_entry__ as e
    names = [q for q in e.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14)) and "pipeline" in e.queries()
