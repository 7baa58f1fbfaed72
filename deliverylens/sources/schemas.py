"""Table schemas: raw CSV inputs (all text) and the typed staging / fact tables."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_COLUMNS = {
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
               "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id",
                    "shipping_limit_date", "price", "freight_value"],
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix",
                  "customer_city", "customer_state"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                    "geolocation_city", "geolocation_state"],
    "products": ["product_id", "product_category_name", "product_name_lenght",
                 "product_description_lenght", "product_photos_qty", "product_weight_g",
                 "product_length_cm", "product_height_cm", "product_width_cm"],
    "order_reviews": ["review_id", "order_id", "review_score", "review_comment_title",
                      "review_comment_message", "review_creation_date",
                      "review_answer_timestamp"],
}

RAW_TABLES = tuple(RAW_COLUMNS)


def raw_schema(name: str) -> T.StructType:
    """Every raw column is read as text and converted explicitly later."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS[name]])


TS = T.TimestampNTZType()
S, D, I = T.StringType(), T.DoubleType(), T.IntegerType()


def _struct(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STAGING = {
    "stg_orders": _struct([
        ("order_id", S), ("customer_id", S), ("order_status", S),
        ("order_purchase_timestamp", TS), ("order_approved_at", TS),
        ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
        ("order_estimated_delivery_date", TS),
        ("approval_time_days", D), ("seller_processing_days", D),
        ("carrier_transit_days", D), ("actual_delivery_days", D), ("delay_days", D),
        ("is_delayed", I)]),
    "stg_order_items": _struct([
        ("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
        ("shipping_limit_date", TS), ("price", D), ("freight_value", D)]),
    "stg_customers": _struct([
        ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
        ("customer_city", S), ("customer_state", S)]),
    "stg_sellers": _struct([
        ("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S),
        ("seller_state", S)]),
    "stg_geolocation": _struct([
        ("geolocation_zip_code_prefix", S), ("lat", D), ("lng", D), ("city", S),
        ("state", S)]),
    "stg_products": _struct([
        ("product_id", S), ("product_category_name", S), ("product_name_lenght", I),
        ("product_description_lenght", I), ("product_photos_qty", I),
        ("product_weight_g", D), ("product_length_cm", D), ("product_height_cm", D),
        ("product_width_cm", D)]),
    "stg_order_reviews": _struct([
        ("review_id", S), ("order_id", S), ("review_score", I),
        ("review_creation_date", TS), ("review_answer_timestamp", TS)]),
}

# Sort keys of the staging tables (used when writing, for row-group pruning).
STAGING_SORT = {
    "stg_orders": ["order_id", "order_purchase_timestamp"],
    "stg_order_items": ["order_id", "order_item_id"],
    "stg_customers": ["customer_id"],
    "stg_sellers": ["seller_id"],
    "stg_geolocation": ["geolocation_zip_code_prefix"],
    "stg_products": ["product_id"],
    "stg_order_reviews": ["order_id", "review_id"],
}

FACT = _struct([
    ("order_id", S), ("customer_id", S), ("order_status", S),
    ("order_purchase_timestamp", TS), ("order_approved_at", TS),
    ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
    ("order_estimated_delivery_date", TS),
    ("approval_time_days", D), ("seller_processing_days", D), ("carrier_transit_days", D),
    ("actual_delivery_days", D), ("delay_days", D), ("is_delayed", I),
    ("price", D), ("freight_value", D),
    ("product_id", S), ("product_category_name", S), ("product_weight_g", D),
    ("seller_id", S), ("seller_city", S), ("seller_state", S), ("seller_zip_code_prefix", S),
    ("customer_city", S), ("customer_state", S), ("customer_zip_code_prefix", S),
    ("customer_lat", D), ("customer_lng", D),
    ("review_score", I),
])

FACT_COLUMNS = [f.name for f in FACT.fields]
FACT_PARTITION_COLUMN = "purchase_ym"
FACT_SORT = ["order_id", "order_purchase_timestamp"]
