"""Every query against its SQL, and the shape of the plans."""

import pytest

from __spark_entry__ import entry
from compare import connect, differences
from ratepanel.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, database, name):
    assert name in SQL
    assert differences(spark, database, name, SF) is None


def test_entry(spark):
    assert entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


PYTHON = ("Python", "Pandas", "ArrowEval", "MapIn")


@pytest.mark.parametrize("name", list(QUERIES))
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert not any(p in plan for p in PYTHON)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["extract_rate_rows", "extract_date_row", "extract_by_header", "extract_by_position"])
def test_extraction_shuffles_only_to_sum_up(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert plan.count("Exchange hashpartitioning") == 1
    # The page's table is taken out once, not once per cell or entity.
    assert plan.count("(?:!--(") == 1


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(QUERIES["prev_business_day"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    fx = plan_of(QUERIES["panel_to_sml"](spark, SF))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in fx
