import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    s = build_session(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.driver.host": "127.0.0.1",
            "spark.checkpoint.dir": folder,
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def get(df, *names):
        got = [tuple(r) for r in (df.select(*names) if names else df).collect()]
        return sorted(got, key=lambda t: tuple((v is None, str(v)) for v in t))

    return get
