import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakemart.session import get_session, checkpoint_dir
    s = get_session("local[8]", app_name="lakemart-tests", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lakemart-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="lakemart-test-")
