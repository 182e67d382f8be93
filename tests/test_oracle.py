"""Every registered query against its SQL counterpart."""

import os

import pytest

from filmlens import registry
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, con, name):
    assert differences(registry.queries()[name](spark, SF_DIR), con, registry.oracle_sql()[name]) == []


def test_entry_runs(spark):
    import __spark_entry__

    found = __spark_entry__.entry(spark)
    assert found.columns == ["o_orderkey", "o_year", "o_totalprice"]
    assert found.count() > 0


def test_forbidden_names():
    assert not [n for n in registry.queries() if n.startswith("op") or "pipeline" in n or "llm" in n]
