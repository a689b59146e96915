"""Every registered query against its SQL twin."""

import pytest

from leadforge.catalog import check, registry

QUERIES, ORACLES = registry.queries(), registry.oracles()


@pytest.fixture(scope="module")
def con(folder):
    return check.duck(folder)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_its_twin(spark, folder, con, key):
    result = check.compare(spark, folder, QUERIES[key], ORACLES[key], con)
    assert result["ok"], result["why"]
