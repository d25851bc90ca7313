import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session

    s = build_session("local[4]", app="tessera-tests", shuffle_partitions=4,
                      conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tessera-test-ckpt-"),
                            "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from tessera.plans.compare import duckdb_connection

    return duckdb_connection(SMALL)
