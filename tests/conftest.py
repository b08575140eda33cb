import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from blocklake.session import get_spark

    scratch = tempfile.mkdtemp(prefix="blocklake-tests-")
    s = get_spark(os.environ.get("TEST_MASTER", "local[*]"), **{"spark.sql.shuffle.partitions": "8", "spark.checkpoint.dir": f"{scratch}/ckpt"})
    s.sparkContext.setCheckpointDir(f"{scratch}/ckpt")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def scratch(spark):
    from blocklake.session import checkpoint_root

    return checkpoint_root(spark)
