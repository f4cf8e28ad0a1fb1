import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])  # for Python workers

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from skyledger.session import build_session, local_scratch, prepare

    session = build_session("tests", "local[8]", spark_sql_shuffle_partitions="4", spark_driver_memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    local_scratch(session, str(tmp_path_factory.mktemp("scratch")))
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
