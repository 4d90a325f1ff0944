"""Every registered query against its SQL."""

import pytest

from checks import documents, increments, operators  # noqa: F401
from checks.compare import check, connect
from checks.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert check(spark, con, FOLDER, name) == ""


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
