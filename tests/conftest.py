import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from saldo.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4",
           "spark.driver.memory": "6g",
           "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
