import pytest

from voxscope.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 8, **{"spark.driver.memory": "12g"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
