import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from goldkeel.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = get_session("tests", "local[8]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """Rows as sorted tuples, NULLs comparable."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
