import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from suarakit.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8")


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def apply(spark):
    """Apply a Column function to a list of values and return the results in order."""

    def run(values, fn, kind="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(enumerate(values)), f"i int, c {kind}").repartition(3)
        return [r[1] for r in sorted(df.select("i", fn(F.col("c")).alias("o")).collect(), key=lambda r: r[0])]

    return run
