import pytest

import __spark_entry__ as contract
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, SF_DIR, name, contract.queries()[name], contract.oracle_sql().get(name), con) is None


def test_flagship(spark):
    assert contract.entry(spark).count() > 0


def test_plans_hold_no_python_and_no_cartesian_product(spark):
    for name in ("courier_ledger", "user_profiles", "friend_recommendations", "zone_activity", "nearest_city", "group_conversion"):
        plan = contract.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "PythonUDF"):
            assert node not in plan, f"{name}: {node}"


@pytest.mark.parametrize("name", ("social_vault_twice", "social_satellites", "users_with_messages", "added_users", "group_conversion", "ordered_group_conversion", "auth_history"))
def test_social_queries_do_not_parse_documents_for_each_table(spark, name):
    plan = contract.queries()[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan and "props" not in plan
