"""Every registered query against its SQL twin, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_oracle  # noqa: E402

from basketry.plans.catalog import QUERIES  # noqa: E402
from basketry.plans.oracles import ORACLES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    ok, note = check_oracle.compare(spark, con, name, FOLDER)
    assert ok, note


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
