import pytest

from portloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, app="portloom-tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A fresh path as text."""
    return lambda name: str(tmp_path / name)


def rows(df, *cols):
    """Rows as a sorted list of tuples, nulls first."""
    df = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
