import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from alertloom.session import build_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": f"{shared}/warehouse"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
