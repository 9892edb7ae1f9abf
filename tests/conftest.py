import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF = pathlib.Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from plantpulse.session import build_session
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
           "spark.ui.showConsoleProgress": "false",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
           "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return str(SF)
