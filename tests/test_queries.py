"""Every registered query against its SQL."""

import pytest

from checks.compare import mismatch, oracle_connection
from checks.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert mismatch(spark, con, name, SF) is None


def test_only_trained_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == {"learned_rules", "feature_importance"}
    assert not set(ORACLES) - set(QUERIES)
