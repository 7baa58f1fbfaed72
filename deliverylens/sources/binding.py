"""Binding of the given TPC-H-style tables to the reference's seven raw inputs.

The reference reads seven order-delivery CSVs that are not shipped; the test
tables are a TPC-H-like star schema. This module derives the seven inputs
from them with deterministic integer arithmetic (same rules as the DuckDB
oracle in ``plans/oracle.py``), so every query's work grows with the given
tables. Columns come out typed (text ids, numbers, timestamp_ntz); the
cleaning operators accept typed or text input alike.

Notation: k = o_orderkey; s = supplier of the order's first line (0 if the
order has no line); n = nation key of the order's customer; h(x) = x hours.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.operators.sequence import number_within_groups
from deliverylens.session import shared_dir

SOURCE_TABLES = ("orders", "lineitem", "customer", "supplier", "part", "nation")


def read_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _plus_hours(ts: Column, hours: Column) -> Column:
    return F.timestamp_add("HOUR", hours, ts)


def _str(c: str) -> Column:
    return F.col(c).cast("string")


def first_line_supplier(lineitem: DataFrame) -> DataFrame:
    """Supplier of each order's first line, first = smallest
    (l_linenumber, l_partkey, l_suppkey). A grouped min over a struct:
    partial aggregation runs map-side, so a hot order key costs one row per
    map task in the shuffle."""
    return (lineitem.groupBy("l_orderkey")
            .agg(F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("f"))
            .select(F.col("l_orderkey").alias("fl_orderkey"),
                    F.col("f.l_suppkey").alias("fl_suppkey")))


def first_item_supplier(items: DataFrame) -> DataFrame:
    """``first_line_supplier`` from the numbered items (``raw_order_items``, as
    written): the numbering has compared an order's lines already, so one narrow
    row per order is left to shuffle."""
    return items.where("order_item_id = 1 AND order_id IS NOT NULL").select(
        F.col("order_id").cast("long").alias("fl_orderkey"), F.col("seller_id").cast("long").alias("fl_suppkey"))


def raw_orders(orders: DataFrame, lineitem: DataFrame, customer: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """``items``: the numbered items, if they are written already."""
    first = first_line_supplier(lineitem) if items is None else first_item_supplier(items)
    cust = customer.select(F.col("c_custkey").alias("oc_custkey"),
                           F.col("c_nationkey").alias("oc_nationkey"))
    o = (orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
         .join(first, F.col("o_orderkey") == F.col("fl_orderkey"), "left")
         .join(cust, F.col("o_custkey") == F.col("oc_custkey"), "left"))
    k = F.col("o_orderkey")
    s = F.coalesce(F.col("fl_suppkey"), F.lit(0))
    n = F.coalesce(F.col("oc_nationkey"), F.lit(0))
    purchase = _plus_hours(F.col("o_orderdate"), (k * 7) % 24)
    approved = F.when(k % 97 == 0, F.lit(None)).otherwise(
        _plus_hours(purchase, (k * 13) % 49 - 1))
    carrier = _plus_hours(approved, (s % 5) * 72 + k % 60 - 12)
    late_tail = F.when(k % 200 == 7, F.lit(480)).otherwise(F.lit(0))
    delivered = F.when(k % 101 == 0, F.lit(None)).otherwise(
        _plus_hours(carrier, (k * 17) % 241 + (n % 5) * 24 - 4 + late_tail))
    # never before an hour after the purchase (a negative total fails the gate)
    delivered = F.when(delivered.isNotNull(), F.greatest(delivered, _plus_hours(purchase, F.lit(1))))
    estimated = _plus_hours(purchase, (k % 15 + 10) * 24)
    return o.select(
        _str("o_orderkey").alias("order_id"),
        _str("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus").isin("F", "O"), F.lit("delivered"))
         .otherwise(F.lit("shipped")).alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        approved.cast("timestamp_ntz").alias("order_approved_at"),
        carrier.cast("timestamp_ntz").alias("order_delivered_carrier_date"),
        delivered.cast("timestamp_ntz").alias("order_delivered_customer_date"),
        estimated.alias("order_estimated_delivery_date"),
    )


def raw_order_items(lineitem: DataFrame, stage_path: str) -> DataFrame:
    """One item per line; ``order_item_id`` numbers the lines of an order by
    (l_linenumber, l_partkey, l_suppkey), with the skew-safe
    ``number_within_groups`` (it stages one table at ``stage_path``, a folder
    in the shared checkpoint area)."""
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    base = lineitem.select("l_orderkey", *order, "l_extendedprice", "l_tax", "l_shipdate")
    numbered = number_within_groups(base, "l_orderkey", order, "_rn", stage_path)
    return numbered.select(
        _str("l_orderkey").alias("order_id"),
        F.col("_rn").cast("int").alias("order_item_id"),
        _str("l_partkey").alias("product_id"),
        _str("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_tax").alias("freight_value"),
    )


def raw_products(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    size = F.col("p_size")
    category = F.when(pk % 89 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lower("p_type"), F.when(size > 25, F.lit("_xl")).otherwise(F.lit(""))))
    return part.select(
        _str("p_partkey").alias("product_id"),
        category.alias("product_category_name"),
        F.length("p_name").cast("int").alias("product_name_lenght"),
        F.when(pk % 7 == 0, F.lit(None)).otherwise(size * 10).cast("int")
         .alias("product_description_lenght"),
        (pk % 4 + 1).cast("int").alias("product_photos_qty"),
        F.when(pk % 113 == 0, F.lit(None)).otherwise(size * F.lit(100.0))
         .cast("double").alias("product_weight_g"),
        (size * F.lit(1.0)).alias("product_length_cm"),
        (size * F.lit(1.0)).alias("product_height_cm"),
        (size * F.lit(1.0)).alias("product_width_cm"),
    )


def _with_nation(df: DataFrame, key: str, nation: DataFrame, alias: str) -> DataFrame:
    # nation is a fixed 25-row table by definition of the schema: broadcast.
    nat = F.broadcast(nation.select(F.col("n_nationkey").alias(f"{alias}_nk"),
                                    F.col("n_name").alias(f"{alias}_state")))
    return df.join(nat, F.col(key) == F.col(f"{alias}_nk"), "left")


def raw_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    c = _with_nation(customer, "c_nationkey", nation, "cn")
    ck = F.col("c_custkey")
    return c.select(
        _str("c_custkey").alias("customer_id"),
        (ck % 1000).cast("string").alias("customer_unique_id"),
        (ck % 997).cast("string").alias("customer_zip_code_prefix"),
        F.concat(F.lit("city_"), (ck % 40).cast("string")).alias("customer_city"),
        F.col("cn_state").alias("customer_state"),
    )


def raw_sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    s = _with_nation(supplier, "s_nationkey", nation, "sn")
    sk = F.col("s_suppkey")
    return s.select(
        _str("s_suppkey").alias("seller_id"),
        (sk % 97).cast("string").alias("seller_zip_code_prefix"),
        F.concat(F.lit("scity_"), (sk % 17).cast("string")).alias("seller_city"),
        F.col("sn_state").alias("seller_state"),
    )


def raw_geolocation(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """One point per customer (many per zip), except zips divisible by 31."""
    c = _with_nation(customer, "c_nationkey", nation, "gn")
    ck = F.col("c_custkey")
    zip_ = ck % 997
    return c.filter(zip_ % 31 != 0).select(
        zip_.cast("string").alias("geolocation_zip_code_prefix"),
        (F.lit(-30.0) + ((ck * 37) % 4000) / F.lit(100.0)).alias("geolocation_lat"),
        (F.lit(-60.0) + ((ck * 53) % 4000) / F.lit(100.0)).alias("geolocation_lng"),
        F.concat(F.lit("city_"), (ck % 40).cast("string")).alias("geolocation_city"),
        F.col("gn_state").alias("geolocation_state"),
    )


def raw_order_reviews(orders: DataFrame) -> DataFrame:
    """One review for 9 of 10 orders; a second one for k % 50 = 1; score 9 is invalid."""
    k = F.col("o_orderkey")
    created = _plus_hours(F.col("o_orderdate"), (k % 20 + 10) * 24)

    def review(suffix: str, score: Column) -> list[Column]:
        return [
            F.concat(F.lit("rv"), k.cast("string"), F.lit(suffix)).alias("review_id"),
            k.cast("string").alias("order_id"),
            score.cast("int").alias("review_score"),
            F.when(k % 3 == 0, F.concat(F.lit("title "), (k % 5).cast("string")))
             .alias("review_comment_title"),
            F.when(k % 4 == 0, F.lit("ok")).alias("review_comment_message"),
            created.alias("review_creation_date"),
            _plus_hours(created, k % 72).alias("review_answer_timestamp"),
        ]

    first = orders.filter(k % 10 != 0).select(
        *review("", F.when(k % 61 == 0, F.lit(9)).otherwise((k * 7) % 5 + 1)))
    second = orders.filter(k % 50 == 1).select(*review("b", (k * 3) % 5 + 1))
    return first.unionByName(second)


def raw_table_builders(spark: SparkSession, sf_dir: str, stage_dir: str | None = None
                       ) -> dict[str, Callable[..., DataFrame]]:
    """One builder without arguments per raw input, so independent tables can be
    built (and written) concurrently; that of the orders may be given the items as
    written. The item numbering stages one table
    under ``stage_dir`` (default: a new folder in the session's shared
    checkpoint area)."""
    src = {name: read_source(spark, sf_dir, name) for name in SOURCE_TABLES}
    if stage_dir is None:
        stage_dir = os.path.join(shared_dir(spark), f"binding-{uuid.uuid4().hex[:12]}")
    items_stage = os.path.join(stage_dir, "_items_ranged")
    return {
        "orders": lambda items=None: raw_orders(src["orders"], src["lineitem"], src["customer"], items),
        "order_items": lambda: raw_order_items(src["lineitem"], items_stage),
        "customers": lambda: raw_customers(src["customer"], src["nation"]),
        "sellers": lambda: raw_sellers(src["supplier"], src["nation"]),
        "geolocation": lambda: raw_geolocation(src["customer"], src["nation"]),
        "products": lambda: raw_products(src["part"]),
        "order_reviews": lambda: raw_order_reviews(src["orders"]),
    }


def raw_tables(spark: SparkSession, sf_dir: str,
               stage_dir: str | None = None) -> dict[str, DataFrame]:
    """The seven raw inputs (see ``raw_table_builders``)."""
    return {name: build() for name, build in
            raw_table_builders(spark, sf_dir, stage_dir).items()}


def translation_table(products: DataFrame) -> DataFrame:
    """A translation table (code -> English code) derived from the catalogue.

    Mirrors the shipped CSV's shape. Codes starting with 'promo' are left out
    (they take the fallback) and 'large' / 'large_xl' share one label (they
    merge when grouped). Bounded by the number of category codes.
    """
    code = F.col("product_category_name")
    return (products.select(code).filter(code.isNotNull() & ~code.startswith("promo"))
            .distinct()
            .select(code, F.concat(F.when(code == "large_xl", F.lit("large")).otherwise(code),
                                   F.lit("_en")).alias("product_category_name_english")))
