import pytest

from stopflow.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("8", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def clear_cache(spark):
    yield
    spark.catalog.clearCache()
