import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from carriageway import build_session

    runs = tmp_path_factory.mktemp("runs")
    session = build_session("tests", "local[8]", **{
        "spark.checkpoint.dir": str(runs / "shared"), "spark.sql.warehouse.dir": str(runs / "warehouse"),
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def oracle():
    from compare import oracle_connection

    return oracle_connection()
