"""Every registered query on the smallest data set against its SQL."""

import os

import pytest
from oracle import compare, connect

from filmloom.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_whole_tables_reach_the_scan_pruned(spark):
    plan = QUERIES["f1_changed_since"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "GreaterThan(o_orderdate" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


@pytest.mark.parametrize("name", ["r13_film_documents", "j2_full_outer_chain", "r2_film_list", "x6_relevance_order", "u1_union_of_affected"])
def test_plans_hold_no_cross_product(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
