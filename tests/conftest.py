import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from plymill.session import local_session

    session = local_session("tests", 8, spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def values(spark):
    """Evaluate a column function over single values: ``values(function, kind, *inputs)``."""
    from pyspark.sql import functions as F

    def run(function, kind, *inputs):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}").coalesce(1)
        return [row[0] for row in frame.orderBy("i").select(function(F.col("v"))).collect()]

    return run
