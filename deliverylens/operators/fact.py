"""Joins and the wide delivery fact table.

Plan shape of ``build_fact`` (left-deep, all LEFT joins):

  stg_orders --(order_id)-- first item per order --(order_id)-- reviews
       one hash exchange on order_id serves all three inputs
  --(customer_id)-- customers with their geolocation
       the two dimensions meet on the zip code first, so the wide fact is not
       shuffled on it
  --(product_id)--  products           ) size-checked broadcast, or a join that
  --(seller_id)--   sellers            ) splits hot keys (``hot_join``)

Left joins here only add columns of the joined table, so joining the
order-keyed inputs first (sharing one partitioning) and the dimensions after
gives the same rows as the reference's written order. Broadcasts are left to
Spark's size check (``autoBroadcastJoinThreshold`` / AQE runtime sizes), never
forced on a table that grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deliverylens.operators.hot_join import split_join
from deliverylens.sources.schemas import FACT, FACT_COLUMNS

ITEM_COLUMNS = ["product_id", "seller_id", "price", "freight_value"]


def first_item_per_order(items: DataFrame, order_col: str | None = None) -> DataFrame:
    """The item with the lowest ``order_item_id`` of each order.

    Grouped min over (order_item_id, product_id, seller_id, price, freight),
    items without an id left out (a minimum skips NULL):
    ties on the item id break on the remaining fields, so the result is
    deterministic. Partial aggregation runs before the shuffle, so an order
    with a huge number of items still sends one row per map task.
    ``order_col`` picks the first by another explicit order column instead
    (J9: the notebook's "first row of the file").
    """
    first = order_col or "order_item_id"
    fields = [first] + [c for c in ["order_item_id"] + ITEM_COLUMNS if c != first]
    return (items.groupBy("order_id")
            .agg(F.min(F.when(F.col(first).isNotNull(), F.struct(*fields))).alias("_first"))
            .where("_first IS NOT NULL").select("order_id", *[F.col(f"_first.{c}").alias(c) for c in ITEM_COLUMNS]))


def first_item_semijoin(items: DataFrame) -> DataFrame:
    """J1, literal form: items whose (order_id, order_item_id) is in the
    per-order minimum. Keeps every row tied on the minimum id."""
    mins = items.groupBy("order_id").agg(F.min("order_item_id").alias("order_item_id"))
    return items.join(mins, ["order_id", "order_item_id"], "left_semi") \
        .select("order_id", *ITEM_COLUMNS)


_DEFAULTS = {
    "string": "", "double": 0.0, "int": 0,
}


NULLABLE_FACT_COLUMNS = {"review_score", "order_approved_at"}


def apply_engine_defaults(fact: DataFrame) -> DataFrame:
    """Engine-default LEFT JOIN semantics on a built fact: unmatched columns of
    non-nullable type take the type default ('' or 0) instead of NULL; only
    the columns declared nullable in the fact schema stay NULL. A projection:
    applying it to the stored fact needs no rebuild."""
    return _fill_unmatched(fact, NULLABLE_FACT_COLUMNS)


def _fill_unmatched(fact: DataFrame, nullable: set[str]) -> DataFrame:
    """Fill NULL with the type default for every fact column not in ``nullable``."""
    fill = {}
    for f in FACT.fields:
        if f.name in nullable:
            continue
        default = _DEFAULTS.get(f.dataType.simpleString())
        if default is not None:
            fill[f.name] = default
    return fact.fillna(fill)


def build_fact(stg: dict[str, DataFrame], unmatched: str = "null",
               first_item: str = "sql") -> DataFrame:
    """The 29-column delivery fact, one row per order and review.

    ``unmatched``: "null" (SQL standard, as the pandas path) or "default"
    ('' / 0 for non-nullable columns, as the original warehouse insert did).
    ``first_item``: "sql" (lowest order_item_id) or "semijoin" (literal form).
    """
    orders = stg["stg_orders"]
    items = stg["stg_order_items"]
    oi = first_item_per_order(items) if first_item == "sql" else first_item_semijoin(items)
    oi = oi.select("order_id", F.col("product_id").alias("item_product_id"),
                   F.col("seller_id").alias("item_seller_id"), "price", "freight_value")
    reviews = stg["stg_order_reviews"].select("order_id", "review_score")
    products = stg["stg_products"].select(
        F.col("product_id").alias("p_product_id"), "product_category_name", "product_weight_g")
    sellers = stg["stg_sellers"].select(
        F.col("seller_id").alias("s_seller_id"), "seller_city", "seller_state",
        "seller_zip_code_prefix")
    customers = stg["stg_customers"].select(
        F.col("customer_id").alias("c_customer_id"), "customer_city", "customer_state",
        "customer_zip_code_prefix")
    geo = stg["stg_geolocation"].select(
        F.col("geolocation_zip_code_prefix").alias("g_zip"),
        F.col("lat").alias("customer_lat"), F.col("lng").alias("customer_lng"))

    places = customers.join(geo, F.col("customer_zip_code_prefix") == F.col("g_zip"), "left").drop("g_zip")
    f = (orders.join(oi, "order_id", "left")
         .join(reviews, "order_id", "left")
         .join(places, F.col("customer_id") == F.col("c_customer_id"), "left"))
    f = split_join(f, products, "item_product_id", "p_product_id", ["order_id"],
                   keys=items.select(F.col("product_id").alias("item_product_id")))
    f = split_join(f, sellers, "item_seller_id", "s_seller_id", ["order_id"],
                   keys=items.select(F.col("seller_id").alias("item_seller_id")))
    f = f.withColumns({"product_id": F.col("p_product_id"),
                       "seller_id": F.col("s_seller_id")})
    out = f.select(*[F.col(c).cast(FACT[c].dataType).alias(c) for c in FACT_COLUMNS])
    if unmatched == "default":
        out = apply_engine_defaults(out)
    elif unmatched != "null":
        raise ValueError("unmatched must be 'null' or 'default'")
    return out


def build_fact_pandas_order(stg: dict[str, DataFrame], item_order_col: str) -> DataFrame:
    """The notebook's chain, first item = first by an explicit order column
    of the items table, item ids kept from the item (not the dimension)."""
    orders = stg["stg_orders"]
    oi = first_item_per_order(stg["stg_order_items"], order_col=item_order_col)
    products = stg["stg_products"].select(F.col("product_id").alias("p_product_id"), "product_category_name",
                                          "product_weight_g")
    sellers = stg["stg_sellers"].select(F.col("seller_id").alias("s_seller_id"), "seller_city", "seller_state",
                                        "seller_zip_code_prefix")
    customers = stg["stg_customers"].select("customer_id", "customer_city", "customer_state",
                                            "customer_zip_code_prefix")
    geo = stg["stg_geolocation"].select(
        F.col("geolocation_zip_code_prefix").alias("customer_zip_code_prefix"),
        F.col("lat").alias("customer_lat"), F.col("lng").alias("customer_lng"))
    reviews = stg["stg_order_reviews"].select("order_id", "review_score")
    places = customers.join(geo, "customer_zip_code_prefix", "left")
    f = (orders.join(oi, "order_id", "left").join(reviews, "order_id", "left")
         .join(places, "customer_id", "left"))
    items = stg["stg_order_items"]
    f = split_join(f, products, "product_id", "p_product_id", ["order_id"], keys=items.select("product_id"))
    f = split_join(f, sellers, "seller_id", "s_seller_id", ["order_id"], keys=items.select("seller_id"))
    return f.select(*FACT_COLUMNS)


def slim_fact(orders: DataFrame, customers: DataFrame, geo: DataFrame,
              reviews: DataFrame) -> DataFrame:
    """The map script's chain orders -> customers -> geo -> reviews with
    the geolocation key kept under its own name (``on=`` expression join);
    customers and geo meet first."""
    g = geo.select("geolocation_zip_code_prefix", "lat", "lng")
    c = customers.select("customer_id", "customer_state", "customer_zip_code_prefix").join(
        g, F.col("customer_zip_code_prefix") == F.col("geolocation_zip_code_prefix"), "left")
    return (orders.join(reviews.select("order_id", "review_score"), "order_id", "left")
            .join(c, "customer_id", "left"))


def items_with_products(fact: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """INNER fact -> every item of the order -> its product (fans out).
    Items meet their product first, hot products split, then the fact."""
    own = items.select("order_id", "order_item_id", F.col("product_id").alias("i_product_id"))
    p = products.select(F.col("product_id").alias("p_product_id"), F.col("product_category_name").alias("p_category"))
    known = split_join(own, p, "i_product_id", "p_product_id", ["order_id", "order_item_id"], "inner")
    return fact.join(known.drop("order_item_id"), "order_id")


def fact_with_seller_customer(fact: DataFrame, sellers: DataFrame,
                              customers: DataFrame) -> DataFrame:
    """INNER fact -> sellers (by seller_id) -> customers (by customer_id), hot keys split."""
    s = sellers.select(F.col("seller_id").alias("s_seller_id"),
                       F.col("seller_state").alias("s_state"))
    c = customers.select(F.col("customer_id").alias("c_customer_id"),
                         F.col("customer_state").alias("c_state"))
    sold = split_join(fact, s, "seller_id", "s_seller_id", ["order_id"], "inner")
    return split_join(sold, c, "customer_id", "c_customer_id", ["order_id"], "inner", keys=fact.select("customer_id"))


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
                name: str) -> DataFrame:
    """Referential-integrity check, rows of ``child`` whose non-NULL key
    has no match in ``parent``, as one count row. Rows are counted by key before
    the anti join, so a key of any size crosses it as one row."""
    per_key = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_ck")).agg(
        F.count(F.lit(1)).alias("_n"))
    known = parent.select(F.col(parent_key).alias("_pk"))
    orphans = per_key.join(known, F.col("_ck") == F.col("_pk"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows")).select(
        F.lit(name).alias("relation"), "orphan_rows")
