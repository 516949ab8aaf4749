import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.abspath(__file__))) + ":" + os.environ.get("PYTHONPATH", "")

from reelspark.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    tmp = tmp_path_factory.mktemp("spark")
    session = get_session("tests", "local[4]", {"spark.sql.shuffle.partitions": "4", "spark.log.level": "ERROR", "spark.checkpoint.dir": f"file://{tmp}/shared", "spark.sql.warehouse.dir": f"{tmp}/warehouse", "spark.driver.memory": "4g"})
    yield session
    session.stop()
