import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pricelake.session import build_session

    s = build_session("local[4]", app_name="pricelake-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, order=None):
    """Collected rows as sorted tuples (order-insensitive comparisons)."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: repr(t))
