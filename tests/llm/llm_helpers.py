"""Plain helpers shared by the tests (importable by name)."""

import re

import pytest

SF_CHECK = "/root/testdata/sf0.01"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def words(text, pattern):
    """Byte words of a text with A-Z folded, by a plain regular expression."""
    return re.findall(pattern, (text or "").encode().translate(LOWER))


def document(i, text, lang="en"):
    return (i, text, lang, f"s{(i or 0) % 3}", len(text or ""))


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


@pytest.fixture
def tables(spark, tmp_path):
    """Write tables to a folder as the queries read them: ``tables(documents=rows, ...)`` -> folder."""
    schemas = {
        "documents": "doc_id long, text string, lang string, source string, n_chars long",
        "benchmark": "item_id long, text string",
        "embeddings": "vec_id long, embedding array<float>, label int",
        "conversations": "conv_id long, turn long, role string, text string",
    }

    def write(**rows):
        for name, data in rows.items():
            (spark.createDataFrame(data, schemas[name]).repartition(3).write.mode("overwrite")
             .parquet(f"{tmp_path}/{name}.parquet"))
        return str(tmp_path)

    return write

