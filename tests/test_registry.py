"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module
from tests.compare import duck, mismatch

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    if name in ORACLES:
        assert mismatch(spark, duck(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR) is None
    else:
        assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(ORACLES) <= set(QUERIES)
