from deliverylens.operators import analysis as A
from deliverylens.operators import fact as J
from deliverylens.operators import geo as G
from tests.conftest import rows
from tests.fixtures import staging


def _fact(spark):
    return J.build_fact(staging(spark)).cache()


def test_on_time_counts_and_late_stats(spark):
    f = _fact(spark)
    assert rows(A.on_time_counts(f)) == [(4, 3, 1, 75.0, 25.0)]
    assert rows(A.late_delay_stats(f)) == [(4.0, 4.0)]


def test_stage_statistics_and_bottleneck(spark):
    f = _fact(spark)
    mm = rows(A.stage_mean_median(f), "stage", "mean_days", "median_days")
    assert [r[0] for r in mm] == ["Approval", "Seller Processing", "Carrier Transit"]
    # carrier transit: rows o1 (3.0) x2, o2 (15 - 1/24), o3 (2.25)
    assert mm[2][2] == 3.0
    assert rows(A.bottleneck_stage(f), "bottleneck_stage") == [("Carrier Transit",)]


def test_seller_profile_drops_null_seller_like_pandas(spark):
    f = _fact(spark)
    p = rows(A.seller_profile(f, min_orders=1), "seller_id", "total_orders", "seller_state")
    assert p == [("s1", 3, "MG")]          # the order without an item has no seller


def test_state_layers_before_and_after(spark):
    f = _fact(spark)
    before = dict(rows(G.state_layer(f), "customer_state", "total_orders"))
    after = dict(rows(G.state_layer(f, variant="after"), "customer_state", "total_orders"))
    # RJ has no coordinates: dropped before aggregating, and dropped after too
    # (its mean coordinates are NULL); SP counts all of its rows either way
    assert before == {"SP": 3} and after == {"SP": 3}


def test_delay_intervals_skip_empty_and_outside(spark):
    f = _fact(spark)
    got = rows(A.score_by_delay_interval(f), "delay_bucket", "count")
    assert got == [("Tepat Waktu", 3)]     # the late order has no review


def test_score_drop_and_summary_row(spark):
    f = _fact(spark)
    assert rows(A.score_drop(f), "mean_late") == [(None,)]
    s = A.executive_summary(f, min_orders=1).first().asDict()
    assert s["total_orders"] == 4 and s["bottleneck_stage"] == "Carrier Transit"
    assert s["active_sellers"] == 1 and s["worst_state"] == "SP"


def test_sample_is_bounded_and_deterministic(spark):
    f = _fact(spark)
    a = rows(A.delay_score_sample(f, n=2))
    assert len(a) == 2 and a == rows(A.delay_score_sample(f, n=2))


def test_summary_reads_the_fact_once_and_merges_from_a_finer_rollup(spark):
    from deliverylens.operators import analysis as A
    from deliverylens.plans.warehouse import warehouse_for
    from tests.conftest import SF_SMALL

    fact = warehouse_for(spark, SF_SMALL).fact
    whole = A.executive_summary(fact)
    monthly = warehouse_for(spark, SF_SMALL).table("rollup")
    assert sorted(map(str, monthly.select(*A.rollup(fact).columns).collect())) == sorted(map(str, A.rollup(fact).collect()))
    assert whole.collect() == A.summary_of(monthly).collect()
    assert whole.collect() == A.summary_of(A.merged(monthly, ["customer_state", "seller_id"])).collect()
    assert A.executive_summary(fact)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert A.executive_summary(fact.where("false")).first()["total_orders"] == 0
