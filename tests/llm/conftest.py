import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("length", T.StringType()), T.StructField("score", T.StringType()), T.StructField("label", T.StringType()), T.StructField("component_id", T.StringType())])


@pytest.fixture
def docs(spark):
    """Documents with extra columns whose names clash with those that operators use."""

    def make(rows):
        return spark.createDataFrame([(i, t, lang, "s", len(t or ""), "x", "x", "x", "x") for i, t, lang in rows], DOCS)

    return make


ODD = [
    (1, None, "en"),
    (2, "", "en"),
    (3, "  \t\n ", None),
    (4, "12 34 !!", "en"),
    (5, "hello world hello world again and again", "en"),
    (5, "hello world hello world again and again", "en"),
    (6, "hello world hello world again and again", "en"),
    (7, "Grüße aus Köln, 中文 и кириллица 😀 x'll we're 'tis", "de"),
    (8, "a" * 3000, "en"),
    (9, "word " * 6000, "en"),
    (None, "no id here at all my friend", "en"),
]
