import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kpiforge.session import build_session
    warehouse = tempfile.mkdtemp(prefix="kpiforge-wh-")
    s = build_session("local[4]", 4, app_name="kpiforge-tests",
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()
