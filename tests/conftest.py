import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from contrail.session import get_session

    s = get_session("local[4]", shuffle_partitions=8, app_name="contrail-tests")
    if not s.conf.get("spark.checkpoint.dir", None):  # a cluster names its shared folder
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="contrail-ckpt-"))
    yield s
    s.stop()
