import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from regfacts.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
