import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from riskloom.session import local_session

    session = local_session("4", "6g", "tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "3")
    return session


@pytest.fixture(scope="session")
def sf():
    return TESTDATA


@pytest.fixture(scope="session")
def dataset(spark, sf):
    """The training table of the smoke data, kept for the session."""
    from riskloom.plans import queries as Q

    data = Q._dataset(spark, sf).persist()
    data.count()
    return data
