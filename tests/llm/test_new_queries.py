"""Registered queries against their SQL on the smallest driver tables."""

import os

import pytest
from compare import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
@pytest.mark.parametrize(
    "name", ["op11_importance_resampling", "op12_url_filter", "op13_prefix_trie"]
)
def test_query_equals_sql(spark, name):
    good, message = compare(spark, SF, name)
    assert good, message
