import pytest
from atollgrid.llm.queries import ORACLE, QUERIES

from ..oracle import same


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, name):
    same(spark, QUERIES[name], ORACLE[name], "/root/testdata/sf0.001")


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 11))
