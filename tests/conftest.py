import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from paritas.session import local_session

    s = local_session(cores=8, shuffle_partitions=8, app="paritas-tests")
    yield s
    s.stop()


@pytest.fixture
def hot_rows(spark):
    """Temporarily force the hot-key plan for keys above ``n`` rows."""
    key = "spark.paritas.hotKeyRows"
    old = spark.conf.get(key, None)

    def set_(n):
        spark.conf.set(key, str(n))

    yield set_
    if old is None:
        spark.conf.unset(key)
    else:
        spark.conf.set(key, old)
