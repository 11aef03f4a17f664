import pytest

from faultline.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "faultline-tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as plain tuples, in order of appearance or sorted."""

    def collect(df, *columns, ordered=False):
        found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return found if ordered else sorted(found, key=repr)

    return collect
