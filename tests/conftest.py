import logging
import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from tidemark.session import Tables, local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, "tidemark-tests")
    s.sparkContext.setLogLevel("OFF")
    logging.getLogger("py4j").setLevel(logging.ERROR)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def t(spark):
    return Tables(spark, SF)


@pytest.fixture()
def rows():
    """Rows of a frame as a sorted list of tuples, columns in the given order."""

    def get(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return get
