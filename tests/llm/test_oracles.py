import os

import pytest

from filmlens.llm import registry
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_sql(spark, name):
    assert differences(registry.queries()[name](spark, SF_DIR), connect(SF_DIR), registry.oracle_sql()[name]) == []
