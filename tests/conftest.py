import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    SparkSession.builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).config(
        "spark.ui.showConsoleProgress", "false"
    )
    from touchline.session import build_session, ship_package

    session = build_session("local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()
