import pytest

from landledger.session import get_spark


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests", master="local[4]", shuffle_partitions=4,
        **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
           "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR",
           # no call-site bookkeeping for every column expression
           "spark.python.sql.dataFrameDebugging.enabled": "false"})
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate expressions on a one-row frame and return the values."""
    def run(*columns):
        return tuple(spark.range(1).select(*columns).first())
    return run
