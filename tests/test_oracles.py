import pytest

from panelscope.plans.oracles import oracle_sql
from panelscope.plans.queries import queries

from .oracle import differences, views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return views(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert differences(queries()[name](spark, SF), con, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", ["i_drilldown", "i_corrections", "i_recheck", "i_impact", "i_funnel", "c_merge_provinces", "t_rate_by_period"])
def test_query_runs(spark, name):
    queries()[name](spark, SF).collect()


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
