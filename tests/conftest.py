import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 2, **{
        "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false",
        "spark.sql.files.maxPartitionBytes": "1m"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows as tuples plus a DDL schema to a DataFrame."""
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)
    return make


def rows_of(df, *cols):
    chosen = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in chosen.collect()), key=str)
