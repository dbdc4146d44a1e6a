import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orefold.session import build_session  # noqa: E402
from orefold.sources.workspace import drop_workspace, new_workspace  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="orefold-tests-")
    settings = {"spark.driver.memory": "8g", "spark.checkpoint.dir": folder, "spark.ui.showConsoleProgress": "false"}
    session = build_session("tests", "local[8]", 8, settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def space(spark):
    made = new_workspace(spark, "test")
    yield made
    drop_workspace(spark, made)
