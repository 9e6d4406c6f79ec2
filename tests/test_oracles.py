"""Every registered query of the core library against its SQL."""

import pytest
from compare import same

from epochal.plans import registry

QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf, name):
    same(QUERIES[name](spark, sf), ORACLES[name], sf)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_flagship(spark, sf):
    out = registry.flagship(spark, sf)
    assert out.count() == 2 * spark.read.parquet(f"{sf}/orders.parquet").count()
    assert out.select("id", "player_code").distinct().count() == out.count()
