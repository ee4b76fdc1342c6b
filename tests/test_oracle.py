"""Every registered query against its SQL on the smallest test data."""

from __future__ import annotations

import pytest

from verification.compare import connect, differences
from verification.oracle import all_sql
from verification.queries import all_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_sql())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, connection, name):
    assert differences(spark, connection, name, FOLDER) == []
