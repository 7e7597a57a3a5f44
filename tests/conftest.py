import os

import pytest

from tierwise.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, "6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def store(spark, tmp_path):
    """An empty table store with databases of its own."""
    import uuid

    from tierwise.sources.tables import TableStore

    return TableStore(spark, str(tmp_path), prefix=f"t{uuid.uuid4().hex[:10]}_")


@pytest.fixture
def rows():
    """Collected rows as a sorted list of tuples, NULLs last."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in t])

    return collect
