import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from transhume.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("transhume-tests", cores=8, partitions=4)


@pytest.fixture
def shuffled_joins(spark):
    """No table is small enough to broadcast, as for large lookup tables."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)
