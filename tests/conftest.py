import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quireflow.session import get_spark

    session = get_spark("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.sql.warehouse.dir": "/tmp/quireflow-tests-warehouse",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
