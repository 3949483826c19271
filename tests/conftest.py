import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from flowgrid.session import get_spark
    s = get_spark("local[*]", 8, app_name="flowgrid-tests",
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="flowgrid-test-ckpt-")})
    yield s
    s.stop()


def rows(df):
    return [tuple(r) for r in df.collect()]
