import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from playback_qos.session import checkpoint_dir, get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_spark(
        app_name="playback-qos-tests",
        master="local[4]",
        spark_sql_shuffle_partitions=4,
        conf={"spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    # Only where the session names no shared folder (local tests).
    checkpoint_dir(s, tempfile.mkdtemp(prefix="pq-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="pq-test-")
