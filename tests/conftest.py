import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from headway.session import local_session, new_folder  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session("4", shuffle_partitions=2, memory="4g", warehouse=warehouse)
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return new_folder(spark, "test")
