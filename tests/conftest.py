import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from threadmill.session import get_spark

    import tempfile

    warehouse = tempfile.mkdtemp(prefix="tm-warehouse-", dir="/tmp")
    s = get_spark("threadmill-tests", master="local[*]", shuffle_partitions=8,
                  extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()
