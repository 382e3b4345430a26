import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def collect(df, *names):
        picked = df.select(*names) if names else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect


def merged(spark, path):
    """A bucket table with the columns it was written with."""
    from pyspark.sql import types as T

    from martloom.sources.buckets import BucketTable

    return BucketTable(spark, path, BucketTable(spark, path, T.StructType(), []).columns(), []).read()
