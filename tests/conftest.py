import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodgeworks.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="6g", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def two_columns(spark):
    """Seven rows: one number is null and one row stands there three times."""
    rows = [(8.0, "oak"), (None, "elm"), (8.0, "oak"), (5.0, "ash"), (8.0, "oak"), (1.0, "fir"), (6.0, "yew")]
    return spark.createDataFrame(rows, "feature1 double, feature2 string")


@pytest.fixture
def processed(spark):
    """Four rows of numbers; ``feature1`` orders them."""
    rows = [(3, 12, -7, 2.5), (4, 11, 0, 0.25), (9, 2, 31, -1.0), (20, 2, 8, 4.0)]
    return spark.createDataFrame(rows, "feature1 long, feature2 long, feature3 long, feature4 double")


def with_columns(spark, df, schema, values):
    """``df`` beside further columns given row by row."""
    rows = [tuple(r) + tuple(v) for r, v in zip(df.collect(), values)]
    return spark.createDataFrame(rows, f"{df._jdf.schema().toDDL()}, {schema}")
