import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from headway.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app="headway-tests")
    yield s
    s.stop()


@pytest.fixture
def catalog(spark):
    from headway.sources.catalog import SourceCatalog

    def make(**tables):
        return SourceCatalog(spark, {k: (lambda v=v: v) for k, v in tables.items()})
    return make
