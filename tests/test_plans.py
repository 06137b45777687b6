"""Physical-plan checks: no all-pairs joins anywhere; reports prune and push down."""

import re

import pytest

from conftest import SF_SMALL
from txnscope.plans import catalog
from txnscope.plans.registry import use_warehouse

import __spark_entry__ as E

EAGER = {q.name for q in catalog.model_queries() if q.sql is None} | {
    q.name for q in catalog.streaming_queries()}


def _plan(capsys, df) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(
    n for n in E.queries() if n not in EAGER and not re.match(r"op\d+_|pipeline", n)))
def test_no_cartesian_or_nested_loop_join(spark, capsys, name):
    plan = _plan(capsys, E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_report_prunes_months_and_columns(spark, capsys):
    use_warehouse(spark, SF_SMALL, ("lineitem",))
    plan = _plan(capsys, E.queries()["merchant_churn"](spark, SF_SMALL))
    scan = plan[plan.index("Scan parquet"):]
    assert "PartitionFilters: [isnotnull(txn_month" in scan
    assert "GreaterThanOrEqual(timestamp" in scan
    read_schema = scan[scan.index("ReadSchema"):].splitlines()[0]
    assert "merchant_category" in read_schema and "transaction_id" not in read_schema
    assert "amount_inr" not in read_schema


@pytest.mark.parametrize("name", ["graph_risk_scores", "fraud_subgraph", "network_edges_last_flag",
                                  "shape_report", "amount_boxstats_by_fraud"])
def test_payments_are_not_shuffled_on_a_few_codes(spark, name):
    """Even with automatic broadcasts off, the bounded sides go to every task."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    codes = r"(sender_bank|receiver_bank|_src|_dst|fraud_flag)"
    assert not re.search(rf"(SortMergeJoin|ShuffledHashJoin) \[{codes}", plan)
    assert "BroadcastHashJoin" in plan


@pytest.mark.parametrize("name", ["describe_numeric", "amount_boxstats_by_fraud",
                                  "insight_high_amount", "scaled_features"])
def test_quantiles_need_no_limit_and_no_value_map(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "percentile" not in plan and "GlobalLimit" not in plan
