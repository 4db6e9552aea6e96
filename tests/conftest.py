import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millwright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "2", "spark.default.parallelism": "2", "spark.checkpoint.dir": folder,
           "spark.sql.warehouse.dir": folder + "/warehouse", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
