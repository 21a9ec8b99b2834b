import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulsegrid.session import build_session, checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="pulsegrid-tests", shuffle_partitions=4,
                      extra={"spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="pulsegrid-test-", dir="/tmp")
