import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from framelake import session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    built = session.build("tests", "local[8]", 8, extra={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g", "spark.sql.shuffle.partitions": "8"})
    built.sparkContext.setLogLevel("ERROR")
    session.ship_package(built)
    yield built
    built.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
