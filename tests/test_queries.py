import __spark_entry__
import pytest
from atollgrid.plans.queries import ORACLE, QUERIES

from .oracle import same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, name):
    same(spark, QUERIES[name], ORACLE[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert "ndvi" in df.columns and df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
