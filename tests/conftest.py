import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from fleetscope.operators import hot  # noqa: E402
from fleetscope.session import build_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def split_small(spark):
    """Treat every key with more than a handful of rows as hot."""
    spark.conf.set(hot.MIN_ROWS, "7")
    spark.conf.set(hot.MAX_SPLITS, "1000")
    yield
    spark.conf.unset(hot.MIN_ROWS)
    spark.conf.unset(hot.MAX_SPLITS)


@pytest.fixture(scope="session")
def sf_dir():
    return SF
