"""Every query against its check SQL."""

import __spark_entry__ as driver
import pytest
from check import compare

from tests.conftest import SF_DIR
from tillscope.catalog import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con):
    line = compare(spark, con, SF_DIR, name)
    assert line.startswith(("ok", "rows")), line


def test_every_check_has_its_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() == 10
