import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from logbarge.settings import configure, local_session, own_shared_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("*", partitions=4, app="tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    own_shared_folder(session, str(tmp_path_factory.mktemp("shared")))
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
