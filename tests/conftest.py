import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import build_session

    warehouse = tempfile.mkdtemp(prefix="quarry-wh-")
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="quarry-tests",
                      extra={"spark.sql.warehouse.dir": warehouse,
                             "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="quarry-test-")


def rows(df, *cols):
    """Sorted list of tuples, for order-insensitive comparison."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
