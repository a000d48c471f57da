import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemill.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture
def frame(spark):
    """Build a table from rows and a schema text; times are given as text."""

    def build(rows, schema):
        from pyspark.sql import functions as F

        fields = [f.strip().split(" ") for f in schema.split(",")]
        text = ", ".join(f"{n} {'string' if k in ('timestamp_ntz', 'date') else k}" for n, k in fields)
        df = spark.createDataFrame(rows, text)
        return df.select(*[F.col(n).cast(k).alias(n) for n, k in fields])

    return build
