import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from fareline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("fareline-tests", "local[4]", 4, **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.maxMetadataStringLength": "5000", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
