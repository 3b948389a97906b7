import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    from tidemark.llm.queries import reachable
    reachable(spark)


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs or (id, text, lang) triples."""
    def make(*rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, "s", 0) for r in rows], DOCS)
    return make


def by_id(df, key="doc_id"):
    """Rows as dictionaries by id."""
    return {r[key]: r.asDict() for r in df.collect()}


# Odd rows that every operator must take: null, empty, blank, one word, a very long text, ties, odd characters.
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "Same words here, the same."), (6, "same words here, the same."),
       (7, "é́ 中文 😀  x\x00y"), (8, "word " * 60_000), (9, "a" * 200_000), (None, "no id"), (None, None)]
