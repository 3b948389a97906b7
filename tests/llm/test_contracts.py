"""Registration, guards and odd inputs of all operators."""

import pytest

from tests.llm.conftest import ODD, by_id
from tidemark.llm import bpe, exact, html, language, near, packing, quality, queries, suffix, toxicity, warc

OPERATORS = {
    "op2": near.of_documents,
    "op3": lambda d: bpe.of_documents(d, queries.BPE_RANKS, queries.BPE_PATTERN),
    "op5": language.of_documents,
    "op6": quality.of_documents,
    "op8": exact.of_documents,
    "op9": lambda d: packing.of_documents(d, queries.WORD_BPE, 1, 4096),
    "op10": suffix.of_documents,
}


def test_one_query_for_each_operator():
    numbers = sorted(int(k.split("_")[0].removeprefix("op")) for k in queries.queries())
    assert numbers == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.queries())


def test_entry_lists_operators_and_pipeline():
    import __spark_entry__ as entry
    assert set(queries.queries()) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_all_come_back(docs, name):
    rows = OPERATORS[name](docs(*ODD)).collect()
    assert {r["doc_id"] for r in rows} == {r[0] for r in ODD}
    if name != "op9":
        assert len(rows) == len(ODD)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table_gives_empty_table(docs, name):
    assert OPERATORS[name](docs()).collect() == []


def test_clashing_columns_are_ignored(docs, spark):
    from pyspark.sql import functions as F
    plain = docs((1, "a b c d e f"), (2, "A b c d e f"))
    clash = plain
    for c in ("id", "key", "kept", "n", "row", "size", "bucket", "content", "component_id", "text_sha256", "start", "length", "__maybe"):
        clash = clash.withColumn(c, F.lit("x"))
    for name in ("op2", "op6", "op8", "op9", "op10"):
        got, want = ([tuple(r) for r in OPERATORS[name](d).orderBy("doc_id").collect()] for d in (clash, plain))
        assert got == want, name


def test_pages_odd_rows(spark):
    schema = "page_id bigint, url string, html string"
    pages = spark.createDataFrame([(1, None, None), (2, "u\r\nv", ""), (3, "u", "<p>x"), (None, "u", "<p>y"), (3, "u", "<p>x")], schema)
    assert len(html.of_pages(pages).collect()) == 5
    assert len(warc.of_pages(pages).collect()) == 5
    none = spark.createDataFrame([], schema)
    assert html.of_pages(none).collect() == [] and warc.of_pages(none).collect() == []


def test_toxicity_without_labels(docs, spark):
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    found = by_id(toxicity.of_documents(docs(*ODD[:9]), empty))
    assert len(found) == 9 and not any(r["rejected"] for r in found.values())
    assert toxicity.of_documents(docs(), empty).collect() == []


def test_suffix_sorts_hold_whole_contexts_and_bounded_bytes():
    import numpy as np
    key = np.repeat(np.arange(400), np.random.default_rng(1).integers(1, 60, 400))
    sizes = np.full(len(key), 91)
    sizes[key == 7] = suffix.SORT
    cuts = list(suffix._sorts(key, sizes))
    assert [c.start for c in cuts[1:]] == [c.stop for c in cuts[:-1]] and (cuts[0].start, cuts[-1].stop) == (0, len(key))
    assert all(key[c.start] != key[c.start - 1] for c in cuts[1:])
    alone = [len(set(key[c].tolist())) for c in cuts if sizes[c].sum() > suffix.SORT + 60 * 91]
    assert alone == [] or max(alone) <= 8  # the large context ends its stretch
    assert list(suffix._sorts(key[:0], sizes[:0])) == []
