import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tierflow.session import get_spark
    s = get_spark("local[4]", app="tierflow-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tierflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from tierflow.session import work_dir
    return work_dir(spark, "test")
