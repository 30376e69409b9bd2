import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]


@pytest.fixture(scope="session")
def spark():
    from wordloom.session import build_session

    session = build_session("tests", "local[*]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
