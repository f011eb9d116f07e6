import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stayline import session


@pytest.fixture(scope="session")
def spark():
    spark = session.build(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def lines(spark):
    """Text rows as a ``value`` frame."""
    return lambda *rows: spark.createDataFrame([(r,) for r in rows], "value string")


@pytest.fixture
def rows():
    """Collected rows as plain sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
