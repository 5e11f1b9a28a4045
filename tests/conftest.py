import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from casewatch.session import build_session, scratch  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        spark_sql_shuffle_partitions="4", spark_ui_enabled="false", spark_ui_showConsoleProgress="false", spark_driver_memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    with scratch(session):
        yield session
    session.stop()



@pytest.fixture(scope="session")
def sf_dir():
    return SF
