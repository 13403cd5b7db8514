import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="session")
def spark():
    from quarrylake.session import session

    os.environ["PYSPARK_SUBMIT_ARGS"] = "--driver-memory 4g pyspark-shell"
    s = session(
        "tests", spark__master="local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__sql__warehouse__dir="/tmp/quarrylake-warehouse", spark__ui__showConsoleProgress="false",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
