import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from parcelspark.session import get_session, ship_package

    shared = tmp_path_factory.mktemp("shared")
    s = get_session("local[8]", 8, **{"spark.checkpoint.dir": f"file://{shared}", "spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    ship_package(s)
    yield s
    s.stop()
