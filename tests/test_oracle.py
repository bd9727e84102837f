"""Every named query against its DuckDB counterpart."""

import compare
import pytest

from pactlens.plans.oracle import ORACLE
from pactlens.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result(spark, con, name):
    assert compare.differences(QUERIES[name](spark, SF), con, ORACLE[name]) == []
