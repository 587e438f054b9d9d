import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from millrace.session import session

    made = session("local[4]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.default.parallelism": "4"})
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables")
    return SMALL
