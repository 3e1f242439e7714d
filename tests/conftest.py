import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkwell.operators.ordered import MAX_GROUP_CONF  # noqa: E402
from sparkwell.session import build_session, prepare, shared_path  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", master="local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    prepare(session)
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture
def folder(spark):
    return shared_path(spark, "test")


@pytest.fixture
def tiny_groups(spark):
    """Every group above twenty rows counts as oversized."""
    spark.conf.set(MAX_GROUP_CONF, "20")
    yield
    spark.conf.unset(MAX_GROUP_CONF)
