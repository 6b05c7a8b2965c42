import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexframe.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return get_session("lexframe-tests", cores="8", partitions=8)


@pytest.fixture
def one(spark):
    """Evaluate column functions over single values: one(fn, v1, v2, ...) -> list of results."""
    from pyspark.sql import functions as F

    def run(fn, *values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(fn(F.col("v")).alias("o")).collect()]

    return run
