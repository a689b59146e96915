"""The registered queries that SQL can express, against DuckDB."""

import pytest

from leadforge.catalog import check
from leadforge.llm import catalog


@pytest.mark.parametrize("key", sorted(catalog.ORACLES))
def test_query_matches_its_twin(spark, folder, key):
    result = check.compare(spark, folder, catalog.QUERIES[key], catalog.ORACLES[key], check.duck(folder))
    assert result["ok"], result["why"]
