import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)

from siteledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "siteledger-tests", master="local[8]", shuffle_partitions=4,
        **{"spark.driver.memory": "8g", "spark.ui.enabled": "false",
           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Frame maker: rows(schema, row, row, ...)."""
    def make(schema, *data):
        return spark.createDataFrame(list(data), schema)
    return make


def values(df, *columns):
    """Row tuples in a fixed order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()),
                  key=lambda t: tuple((v is not None, str(v)) for v in t))
