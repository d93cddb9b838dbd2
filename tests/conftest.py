import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("DOCKSENSE_LOCAL_SCRATCH", tempfile.mkdtemp(prefix="docksense-test-"))


@pytest.fixture(scope="session")
def spark():
    from docksense.session import build_session

    session = build_session("local[8]", "docksense-tests", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
