import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from voxpop.session import get_spark
    s = get_spark("local[4]", app="voxpop-tests", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="voxpop-test-ckpt-")})
    yield s
    s.stop()
