"""Plan properties that matter at scale, checked on the physical plans."""

import re

import pytest

from deliverylens.plans import registry
from deliverylens.operators import kpis
from deliverylens.operators.fact import build_fact
from deliverylens.plans.warehouse import warehouse_for
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_kpi_scan_reads_only_needed_columns(spark):
    plan = _plan(kpis.state_performance(warehouse_for(spark, SF_SMALL).fact))
    scanned = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    cols = {c.split("#")[0] for c in scanned.split(",")} - {"purchase_ym", "v"}  # partition columns
    assert cols == {"customer_state", "actual_delivery_days", "carrier_transit_days",
                    "is_delayed", "review_score"}


def test_fact_joins_on_order_id_share_one_partitioning(spark):
    wh = warehouse_for(spark, SF_SMALL)
    old = {k: spark.conf.get(k) for k in ["spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.enabled"]}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # plan as at full scale
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(build_fact(wh.staging()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    on_order = re.findall(r"Exchange hashpartitioning\(order_id#\d+", plan)
    # orders, the first-item partial aggregate and reviews: one exchange each;
    # the two joins on order_id and the final first-item aggregate add none
    assert len(on_order) == 3
    assert "SortMergeJoin [order_id" in plan


def test_first_item_aggregates_before_the_shuffle(spark):
    plan = _plan(build_fact(warehouse_for(spark, SF_SMALL).staging()))
    assert "partial_min(CASE WHEN isnotnull(order_item_id" in plan


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_cartesian_product(spark, name):
    plan = _plan(registry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
