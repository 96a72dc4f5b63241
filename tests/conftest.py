import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from lakeops.session import local_session

    session = local_session("lakeops-tests", "8", "6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def cleaned(spark):
    """Apply a column expression to texts."""
    from pyspark.sql import functions as F

    def run(fn, values):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
        return [r[0] for r in rows.select("i", fn(F.col("x")).alias("y")).orderBy("i").select("y").collect()]

    return run
