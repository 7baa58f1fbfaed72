from deliverylens.operators import fact as J
from tests.conftest import rows
from tests.fixtures import staging


def test_fact_grain_first_item_and_unmatched(spark):
    stg = staging(spark)
    f = J.build_fact(stg)
    assert len(f.columns) == 29
    got = rows(f.orderBy("order_id", "review_score"), "order_id", "product_id", "seller_id",
               "price", "customer_lat", "review_score")
    assert got == [
        ("o1", "p1", "s1", 10.0, -23.5, 2),    # lowest item id; two reviews -> two rows
        ("o1", "p1", "s1", 10.0, -23.5, 4),
        ("o2", None, None, None, -23.5, None),  # no item, no review
        ("o3", "p3", "s1", 30.0, None, 5),     # customer zip without coordinates
    ]
    dflt = J.build_fact(stg, unmatched="default").filter("order_id = 'o2'")
    assert rows(dflt, "product_id", "price", "customer_lat") == [("", 0.0, -23.5)]


def test_first_item_semijoin_matches_aggregate(spark):
    stg = staging(spark)
    a = rows(J.first_item_per_order(stg["stg_order_items"]).orderBy("order_id"))
    b = rows(J.first_item_semijoin(stg["stg_order_items"]).orderBy("order_id"))
    assert a == b == [("o1", "p1", "s1", 10.0, 1.0), ("o3", "p3", "s1", 30.0, 3.0)]


def test_dimension_ids_vs_item_ids(spark):
    stg = staging(spark)
    stg["stg_products"] = stg["stg_products"].filter("product_id <> 'p1'")
    sql_path = J.build_fact(stg).filter("order_id = 'o1'")
    pandas_path = J.build_fact_pandas_order(stg, "order_item_id").filter("order_id = 'o1'")
    assert {r[0] for r in rows(sql_path, "product_id")} == {None}
    assert {r[0] for r in rows(pandas_path, "product_id")} == {"p1"}


def test_orphans_and_inner_joins(spark):
    stg = staging(spark)
    o = J.orphan_keys(stg["stg_order_items"], stg["stg_products"].filter("product_id <> 'p3'"),
                      "product_id", "product_id", "items->products")
    assert rows(o) == [("items->products", 1)]
    f = J.build_fact(stg)
    assert J.items_with_products(f, stg["stg_order_items"], stg["stg_products"]).count() == 6
    assert J.fact_with_seller_customer(f, stg["stg_sellers"], stg["stg_customers"]).count() == 3


def test_engine_defaults_on_stored_fact_equal_rebuild(spark):
    stg = staging(spark)
    a = sorted(rows(J.build_fact(stg, unmatched="default")), key=str)
    b = sorted(rows(J.apply_engine_defaults(J.build_fact(stg))), key=str)
    assert a == b
