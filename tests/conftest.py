import pytest

from amalgrid.session import get_spark


@pytest.fixture(scope="session")
def spark():
    session = get_spark("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
