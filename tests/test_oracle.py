"""Every query against its DuckDB oracle on sf0.001 (the driver checks sf0.01)."""

import pytest

from tests.compare import compare
from strata.plans.oracles import oracle_sql
from strata.plans.queries import queries
from tests.conftest import SF_SMALL

SKIP_HEAVY = {"als_rmse", "als_topk"}  # covered by test_recommend


@pytest.mark.parametrize("name", sorted(set(queries()) - SKIP_HEAVY))
def test_query_matches_oracle(spark, name):
    result = compare(spark, name, SF_SMALL)
    if name not in oracle_sql():
        assert result["spark_rows"] > 0
        return
    assert result["columns_match"], result
    assert result["spark_rows"] == result["oracle_rows"], result
    assert result["values_match"], result


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
