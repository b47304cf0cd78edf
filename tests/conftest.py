import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shortlist.session import local_session  # noqa: E402

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "shortlist-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not DATA.exists():
        pytest.skip("no test data")
    return str(DATA)


@pytest.fixture
def rows(spark):
    """Build a frame from a schema text and tuples."""

    def build(schema, data):
        return spark.createDataFrame(data, schema)

    return build
