import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import local_session
    s = local_session(4, shuffle_partitions=8, app="tessera-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def four_points(spark):
    # fixture F3: 0:(0,0) 1:(3,4) 2:(6,8) 3:(0,1)
    return spark.createDataFrame(
        [(0, [0.0, 0.0]), (1, [3.0, 4.0]), (2, [6.0, 8.0]), (3, [0.0, 1.0])],
        "id long, v array<double>")
