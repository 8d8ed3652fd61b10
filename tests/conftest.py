import os

import pytest

from precinct.session import local_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("tests", cores=8, **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SF_DIR


@pytest.fixture(scope="session")
def features(spark, folder, tmp_path_factory):
    """Derived incidents of the test folder, stored once."""
    from precinct.operators import derive
    from precinct.session import materialize
    from precinct.sources import incidents

    path = str(tmp_path_factory.mktemp("features") / "table")
    return materialize(derive(incidents(spark, folder)), path=path)
