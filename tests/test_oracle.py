"""Every registered query against its SQL on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as contract
from compare import compare
from sparkmart.catalog import oracles, registry

SF = "/root/testdata/sf0.001"


def test_contract():
    assert set(oracles.build()) == set(registry.QUERIES)
    assert registry.QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    out = contract.entry(spark)
    assert out.columns == ["category_name", "orders", "units_sold", "revenue"] and out.count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    good, message = compare(spark, SF, name)
    assert good, message
