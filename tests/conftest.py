import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.workspace import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", cores="4", shuffle_partitions=4)


@pytest.fixture
def values(spark):
    """A table with one ``value`` text per argument."""
    return lambda *texts: spark.createDataFrame([(text,) for text in texts], "value string")
