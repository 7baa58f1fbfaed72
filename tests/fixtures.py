"""Hand-made staging rows (FIXTURES.md section 5): NULLs, ties, bucket
edges, an order without item / review, one with two reviews."""

from __future__ import annotations

import datetime as dt

from deliverylens.sources.schemas import STAGING


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def staging(spark):
    # order o1: Monday purchase, 1 day approval, 2 days processing, 3 days
    #   transit, delivered exactly at the estimate (not late), two reviews.
    # order o2: late by 4 days, no review, no item.
    # order o3: approval before purchase (clipped), Sunday, score 5.
    orders = [
        ("o1", "c1", "delivered", ts("2024-01-01 10:00:00"), ts("2024-01-02 10:00:00"),
         ts("2024-01-04 10:00:00"), ts("2024-01-07 10:00:00"), ts("2024-01-07 10:00:00"),
         1.0, 2.0, 3.0, 6.0, 0.0, 0),
        ("o2", "c1", "delivered", ts("2024-01-02 05:00:00"), ts("2024-01-02 06:00:00"),
         ts("2024-01-05 06:00:00"), ts("2024-01-20 05:00:00"), ts("2024-01-16 05:00:00"),
         1 / 24, 3.0, 15 - 1 / 24, 18.0, 4.0, 1),
        ("o3", "c2", "delivered", ts("2024-01-07 18:00:00"), ts("2024-01-07 12:00:00"),
         ts("2024-01-08 12:00:00"), ts("2024-01-10 18:00:00"), ts("2024-01-12 18:00:00"),
         0.0, 1.0, 2.25, 3.0, -2.0, 0),
    ]
    items = [
        ("o1", 2, "p2", "s2", None, 20.0, 2.0),
        ("o1", 1, "p1", "s1", None, 10.0, 1.0),
        ("o3", 1, "p3", "s1", None, 30.0, 3.0),
        ("o3", 2, "p1", "s1", None, 5.0, 0.5),
    ]
    customers = [("c1", "u1", "100", "city_a", "SP"), ("c2", "u2", "200", "city_b", "RJ")]
    sellers = [("s1", "900", "scity_1", "MG"), ("s2", "901", "scity_2", "PR")]
    geo = [("100", -23.5, -46.6, "city_a", "SP")]
    products = [("p1", "ferramentas_jardim", 10, 100, 1, 500.0, 1.0, 1.0, 1.0),
                ("p2", "construcao_ferramentas_jardim", 10, 100, 1, 500.0, 1.0, 1.0, 1.0),
                ("p3", "brand_new_code", 10, 100, 1, 500.0, 1.0, 1.0, 1.0)]
    reviews = [("r1", "o1", 4, None, None), ("r1b", "o1", 2, None, None),
               ("r3", "o3", 5, None, None)]
    data = {"stg_orders": orders, "stg_order_items": items, "stg_customers": customers,
            "stg_sellers": sellers, "stg_geolocation": geo, "stg_products": products,
            "stg_order_reviews": reviews}
    return {k: spark.createDataFrame(v, STAGING[k]) for k, v in data.items()}
