"""Every registered query equals its SQL on the smallest scale."""

import pytest
import verify

from tidemark.catalog import load_all

FOLDER = "/root/testdata/sf0.001"
QUERIES = load_all()


@pytest.fixture(scope="module")
def con():
    return verify.connect(FOLDER)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_equals_sql(spark, con, key):
    result = verify.compare(con, spark, QUERIES[key], FOLDER)
    assert not result.startswith("FAIL"), result


def test_entry_contract(spark):
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1


def test_every_operator_is_registered():
    wanted = {f"{p}{i:02d}" for p, n in (("S", 15), ("K", 10), ("U", 11), ("D", 9), ("P", 12), ("J", 19), ("A", 14), ("W", 8),
                                         ("T", 6), ("O", 2), ("F", 19), ("C", 10), ("X", 9), ("N", 3), ("Q", 7), ("B", 40))
              for i in range(1, n + 1)}
    assert wanted == {k.split("_")[0] for k in QUERIES}
