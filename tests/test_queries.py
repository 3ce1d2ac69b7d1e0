"""Every query of the library against its SQL, at the smallest size."""

import pytest

from siftwell.plans import audit_queries, code_queries, curation_queries, more_queries, rule_queries  # noqa: F401
from siftwell.plans.registry import ORACLES, QUERIES

from oracle import DATA, expected, found


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert found(QUERIES[name](spark, f"{DATA}/sf0.001")) == expected(ORACLES[name], "sf0.001")
