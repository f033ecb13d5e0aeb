import pytest

from folioflow.session import get_session


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
