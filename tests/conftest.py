import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from marketlake.session import lake_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = lake_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    return session


def rows(df):
    """Rows of a frame as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
