import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    root = tempfile.mkdtemp(prefix="strata-test-")
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="strata-tests",
                      extra={"spark.checkpoint.dir": f"{root}/checkpoints",
                             "spark.sql.warehouse.dir": f"{root}/warehouse"})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
