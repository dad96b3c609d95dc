import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session

    scratch = tempfile.mkdtemp(prefix="tessera-tests-")
    s = get_session(
        "local[4]",
        shuffle_partitions=4,
        app_name="tessera-tests",
        extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt")},
    )
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from tessera.session import scratch_path

    return scratch_path(spark, "test")
