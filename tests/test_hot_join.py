"""Hot keys: same rows as a plain join, no task with more than a few shares, AQE off."""

import pytest
from pyspark.sql import functions as F

from deliverylens.operators.fact import build_fact, fact_with_seller_customer, items_with_products
from deliverylens.operators.hot_join import hot_keys, small_enough, split_join
from deliverylens.operators.kpis import category_delay, route_performance
from deliverylens.plans.warehouse import warehouse_for
from tests.conftest import SF_SMALL


@pytest.fixture
def at_scale(spark):
    """Plans as for tables too large to broadcast, without runtime re-planning."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def sales(spark, n=24_000):
    """A third of the rows on one seller, an eighth without one, some unknown."""
    seller = F.expr("CASE WHEN id % 3 = 0 THEN 's0' WHEN id % 8 = 1 THEN NULL "
                    "WHEN id % 50 = 2 THEN 'gone' ELSE concat('s', id % 400) END")
    return spark.range(n).select(F.col("id").cast("string").alias("order_id"), seller.alias("seller_id"))


def sellers(spark):
    return spark.range(400).select(F.concat(F.lit("s"), "id").alias("s_id"), (F.col("id") % 7).alias("state"))


def largest_task(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_rows_of_a_plain_join_dealt_evenly(at_scale, how):
    big, dim = sales(at_scale), sellers(at_scale)
    plain = big.join(dim, F.col("seller_id") == F.col("s_id"), how)
    split = split_join(big, dim, "seller_id", "s_id", ["order_id"], how)
    assert split.columns == plain.columns
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
    share = split.count() / 8
    assert largest_task(plain) > 2.5 * share
    assert largest_task(split) < 1.6 * share


def test_only_hot_keys_are_repeated(at_scale):
    hot = {r["hot"]: r["parts"] for r in hot_keys(sales(at_scale), "seller_id").collect()}
    assert set(hot) == {"s0"} and 90 <= hot["s0"] <= 99  # 32 for each of three shares of eight, by an estimate
    plan = split_join(sales(at_scale), sellers(at_scale), "seller_id", "s_id", ["order_id"]
                      )._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [seller_id" in plan and "_part" in plan


def test_small_dimension_is_left_to_the_broadcast(spark):
    dim = sellers(spark)
    assert small_enough(dim)
    plan = split_join(sales(spark), dim, "seller_id", "s_id", ["order_id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "_part" not in plan


def test_no_hot_key_no_rows_and_bad_join(at_scale):
    big, dim = sales(at_scale).where("false"), sellers(at_scale)
    assert hot_keys(big, "seller_id").count() == 0
    assert split_join(big, dim, "seller_id", "s_id", ["order_id"]).count() == 0
    with pytest.raises(ValueError):
        split_join(big, dim, "seller_id", "s_id", ["order_id"], "outer")


def test_fact_and_routes_are_the_same_at_scale(spark, request):
    wh = warehouse_for(spark, SF_SMALL)
    stg, fact = wh.staging(), wh.fact

    def results():
        out = [build_fact(stg), items_with_products(fact, stg["stg_order_items"], stg["stg_products"]),
               fact_with_seller_customer(fact, stg["stg_sellers"], stg["stg_customers"]),
               route_performance(fact, stg["stg_sellers"], stg["stg_customers"], min_orders=1),
               category_delay(fact, stg["stg_order_items"], stg["stg_products"], min_orders=1)]
        return [sorted(map(str, df.collect())) for df in out]

    plain = results()
    request.getfixturevalue("at_scale")
    assert results() == plain
    assert all(plain)


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_eager_aggregation_shuffles_items_once(at_scale):
    wh = warehouse_for(at_scale, SF_SMALL)
    stg = wh.staging()
    found = _exchanges(category_delay(wh.fact, stg["stg_order_items"], stg["stg_products"]))
    # fact per order, items, states per product, products, states per label
    assert len(found) == 5
    assert sum("order_id" in x for x in found) == 2


def test_the_fact_is_not_shuffled_on_the_zip_code(at_scale):
    stg = warehouse_for(at_scale, SF_SMALL).staging()
    found = _exchanges(build_fact(stg))
    on_zip = [x for x in found if "zip" in x]
    assert len(on_zip) == 2  # customers and geolocation, the narrow tables
    # orders, first items, reviews; the wide rows on customer, product and seller; the four dimensions
    assert len(found) == 3 + 3 + 3 + 2
