import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from marketlens.session import get_session
    warehouse = tempfile.mkdtemp(prefix="marketlens-wh-")
    s = get_session("local[4]", app_name="marketlens-tests", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": warehouse}, driver_memory="4g")
    s.sparkContext.setLogLevel("ERROR")
    from marketlens.session import shared_dir
    shared_dir(s)
    yield s
    s.stop()
