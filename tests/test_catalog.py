"""Every clinical query against its SQL, on whole tables."""

import pytest
from compare import differences

from medloom import catalog

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, name):
    assert differences(catalog.QUERIES[name](spark, SF), catalog.SQL[name], SF) == ""


def test_comparison_sees_a_difference(spark):
    assert differences(catalog.QUERIES["table_stats"](spark, SF), "SELECT 1 AS n_rows, 2 AS n_persons", SF)
