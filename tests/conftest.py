import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import local_session
    session = local_session("8", partitions=4, app="tests", scratch=str(tmp_path_factory.mktemp("scratch")))
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    def make(schema: str, *rows):
        return spark.createDataFrame(list(rows), schema)
    return make


def rows(df, *cols):
    """Rows as sorted tuples, NULLs first."""
    data = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(data, key=lambda r: tuple((v is not None, str(v)) for v in r))
