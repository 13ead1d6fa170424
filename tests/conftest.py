import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tillscope.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents conversations labels".split()


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lake(spark):
    from tillscope.lakehouse import lakehouse

    return lakehouse(spark, SF_DIR)


@pytest.fixture(scope="session")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection
