import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from threadloom.session import build_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a column over one row of named values."""
    from pyspark.sql import functions as F

    def run(column, **values):
        df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
        return df.select(column.alias("x")).first()["x"]

    return run
