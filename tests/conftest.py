import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from tallyspark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # catalog tables (bucketed dimensions) go to a scratch warehouse, not the working directory
    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ts-warehouse-")})
    yield s
