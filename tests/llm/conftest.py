import pytest
from pyspark.sql import types as T

DOC = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that the operators use for results of their own
    T.StructField("score", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("n", T.StringType()),
    T.StructField("part", T.StringType()),
    T.StructField("component", T.StringType()),
])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang); the other columns clash with result names."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "src", None, "s", "k", "n", "p", "c") for r in rows]
        return spark.createDataFrame(full, DOC)

    return make


ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "word"),
    (5, "Two words"),
    (5, "Two words"),
    (None, "a text without an id, which is long enough to have some words of its own"),
    (7, "ÉTÉ 東京 😀 naïve don't <|endoftext|> </s> ▁▁ x\x00y   z\r\n"),
    (8, "long " * 5000 + "x" * 20000),
    (-9, "a b c d e f g h i j k l m n o p"),
]


@pytest.fixture(scope="session")
def odd(make_docs):
    return make_docs(ODD_TEXTS)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
