"""Registered profiling (P1-P18), cleaning-audit (C15-C17) and join
queries. Profiles read the raw inputs (the binding of the given tables),
as the profiling notebook reads the raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.operators import clean as C
from deliverylens.operators import fact as J
from deliverylens.operators import profile as P
from deliverylens.plans.oracle import clip_sql, describe_sql, histogram_sql
from deliverylens.plans.registry import fact, register, warehouse_for
from deliverylens.sources.binding import translation_table
from deliverylens.sources.schemas import RAW_COLUMNS

RAW_NAMES = ["orders", "order_items", "customers", "sellers", "geolocation", "products",
             "order_reviews"]
# raw table name -> oracle CTE holding the same rows
RAW_SQL = {"orders": "raw_orders", "order_items": "stg_order_items",
           "customers": "stg_customers", "sellers": "stg_sellers",
           "geolocation": "raw_geolocation", "products": "raw_products",
           "order_reviews": "raw_reviews"}
STAGING_OF = {"orders": "stg_orders", "order_items": "stg_order_items",
              "customers": "stg_customers", "sellers": "stg_sellers",
              "geolocation": "stg_geolocation", "products": "stg_products",
              "order_reviews": "stg_order_reviews"}


def raw(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The bound raw inputs as written in the warehouse's raw zone."""
    return warehouse_for(spark, d).raw()


def stg(spark: SparkSession, d: str, name: str) -> DataFrame:
    return warehouse_for(spark, d).table(name)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _over_raw(fn):
    return lambda spark, d: _union([fn(df, name) for name, df in raw(spark, d).items()])


# ---- P1 - P7 -------------------------------------------------------------------

register("p01_shape", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, count(*) AS rows, {len(RAW_COLUMNS[n])} AS columns "
    f"FROM {RAW_SQL[n]}" for n in RAW_NAMES))(_over_raw(P.shape))


def _missing_sql(n: str) -> str:
    cols = RAW_COLUMNS[n]
    parts = [f"SELECT '{n}' AS table_name, '{c}' AS column_name, count_if({c} IS NULL) "
             f"AS missing_count, round(count_if({c} IS NULL) * CAST(100 AS DOUBLE) / count(*), 2)"
             f" AS missing_pct FROM {RAW_SQL[n]}" for c in cols]
    return "\nUNION ALL\n".join(parts)


register("p03_missing_values", "SELECT * FROM (" + "\nUNION ALL\n".join(
    _missing_sql(n) for n in RAW_NAMES) + ") WHERE missing_count > 0")(
    _over_raw(P.missing_values))


def _dup_sql(n: str) -> str:
    cols = ", ".join(RAW_COLUMNS[n])
    return (f"SELECT '{n}' AS table_name, CAST(coalesce(sum(k - 1), 0) AS BIGINT) AS duplicate_rows,"
            f" round(sum(k - 1) * CAST(100 AS DOUBLE) / sum(k), 2) AS duplicate_pct "
            f"FROM (SELECT count(*) AS k FROM {RAW_SQL[n]} GROUP BY ALL_COLS)"
            ).replace("ALL_COLS", cols)


register("p04_duplicate_rows", "\nUNION ALL\n".join(_dup_sql(n) for n in RAW_NAMES))(
    _over_raw(P.duplicate_rows))

PRODUCT_NUMERIC = ["product_name_lenght", "product_description_lenght", "product_photos_qty",
                   "product_weight_g", "product_length_cm", "product_height_cm",
                   "product_width_cm"]
register("p05_describe_products", describe_sql(PRODUCT_NUMERIC, "raw_products"))(
    lambda spark, d: P.describe_numeric(raw(spark, d)["products"]))
register("p05_describe_items", describe_sql(["order_item_id", "price", "freight_value"],
                                            "stg_order_items"))(
    lambda spark, d: P.describe_numeric(raw(spark, d)["order_items"]))

for _n in RAW_NAMES:
    register(f"p06_head_{_n}", f"SELECT {', '.join(RAW_COLUMNS[_n])} FROM {RAW_SQL[_n]} ORDER BY ALL NULLS FIRST LIMIT 5")(
        lambda spark, d, n=_n: P.head(raw(spark, d)[n]))

# The Spark type names the binding gives each raw column.
RAW_DTYPES = {
    "orders": ["string"] * 3 + ["timestamp_ntz"] * 5,
    "order_items": ["string", "int", "string", "string", "timestamp_ntz", "double", "double"],
    "customers": ["string"] * 5,
    "sellers": ["string"] * 4,
    "geolocation": ["string", "double", "double", "string", "string"],
    "products": ["string", "string", "int", "int", "int", "double", "double", "double", "double"],
    "order_reviews": ["string", "string", "int", "string", "string", "timestamp_ntz",
                      "timestamp_ntz"],
}


_NUMERIC_TYPES = {"int", "double"}
_STATS = {"count": "count({c})", "mean": "round(avg({c}), 2)", "std": "round(stddev_samp({c}), 2)",
          "min": "round(min({c}), 2)", "p25": "round(quantile_cont({c}, 0.25), 2)",
          "p50": "round(quantile_cont({c}, 0.5), 2)", "p75": "round(quantile_cont({c}, 0.75), 2)",
          "max": "round(max({c}), 2)"}


def _profile_sql(n: str, full: bool = True) -> str:
    """P1 to P6 of a table; numbers as Spark writes doubles in text."""
    src, cols = RAW_SQL[n], RAW_COLUMNS[n]
    allc = ", ".join(cols)
    dups = f"(SELECT sum(k - 1) AS d, sum(k) AS n FROM (SELECT count(*) AS k FROM {src} GROUP BY {allc}))"
    parts = [f"SELECT '{n}' AS table_name, CAST(NULL AS VARCHAR) AS column_name, 'rows' AS metric,"
             f" CAST(count(*) AS VARCHAR) AS value FROM {src}",
             f"SELECT '{n}', NULL, 'columns', '{len(cols)}'",
             f"SELECT '{n}', NULL, 'duplicate_rows', CAST(coalesce(d, 0) AS VARCHAR) FROM {dups}",
             f"SELECT '{n}', NULL, 'duplicate_pct', CAST(round(d * CAST(100 AS DOUBLE) / n, 2) AS VARCHAR) FROM {dups}"]
    for c, t in zip(cols, RAW_DTYPES[n]):
        parts.append(f"SELECT '{n}', '{c}', 'dtype', '{t}'")
        parts.append(f"SELECT '{n}', '{c}', 'missing_count', CAST(count_if({c} IS NULL) AS VARCHAR)"
                     f" FROM {src}")
        parts.append(f"SELECT '{n}', '{c}', 'missing_pct', CAST(round(count_if({c} IS NULL) * "
                     f"CAST(100 AS DOUBLE) / count(*), 2) AS VARCHAR) FROM {src}")
        if full and t in _NUMERIC_TYPES:
            parts += [f"SELECT '{n}', '{c}', '{m}', CAST(CAST({e.format(c=c)} AS DOUBLE) AS VARCHAR) FROM {src}"
                      for m, e in _STATS.items()]
    if not full:
        return "\nUNION ALL\n".join(parts)
    head = (f"(SELECT *, row_number() OVER (ORDER BY {', '.join(f'{c} NULLS FIRST' for c in cols)}) AS rn "
            f"FROM (SELECT {allc} FROM {src} ORDER BY ALL NULLS FIRST LIMIT 5))")
    parts += [f"SELECT '{n}', '{c}', 'head_' || rn, CAST({c} AS VARCHAR) FROM {head}" for c in cols]
    return "\nUNION ALL\n".join(parts)


register("p07_profile_dataset", "\nUNION ALL\n".join(_profile_sql(n, False) for n in RAW_NAMES))(
    _over_raw(lambda df, name: P.profile_dataset(df, name, full=False)))
for _n in RAW_NAMES:
    register(f"p07_profile_{_n}", _profile_sql(_n))(
        lambda spark, d, n=_n: P.profile_dataset(raw(spark, d)[n], n))

# ---- P8 - P11 ------------------------------------------------------------------


def _vc_sql(expr: str, src: str, top: int | None = None, by_value: bool = False,
            normalize: bool = False, alias: str = "value") -> str:
    share = (", round(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (), 2) AS share_pct"
             if normalize else "")
    order = f"{alias}" if by_value else f"count DESC, {alias}"
    lim = f" LIMIT {top}" if top else ""
    return (f"SELECT {expr} AS {alias}, count(*) AS count{share} FROM {src} "
            f"WHERE {expr} IS NOT NULL GROUP BY 1 ORDER BY {order}{lim}")


register("p08_status_counts", _vc_sql("order_status", "raw_orders", alias="order_status"))(
    lambda spark, d: P.value_counts(raw(spark, d)["orders"], "order_status"))
register("p08_seller_state_top", _vc_sql("seller_state", "stg_sellers", 10, alias="seller_state"))(
    lambda spark, d: P.value_counts(raw(spark, d)["sellers"], "seller_state", top=10))
register("p08_customer_state_top", _vc_sql("customer_state", "stg_customers", 10,
                                           alias="customer_state"))(
    lambda spark, d: P.value_counts(raw(spark, d)["customers"], "customer_state", top=10))


def _geo_city(spark, d):
    g = C.clean_geolocation(raw(spark, d)["geolocation"], strategy="mean")
    return P.value_counts(g.withColumnRenamed("city", "geolocation_city"), "geolocation_city",
                          top=10)


register("p08_geo_city_top", _vc_sql("city", "stg_geolocation", 10, alias="geolocation_city"))(
    _geo_city)
register("p08_score_counts", _vc_sql("review_score", "raw_reviews", by_value=True,
                                     alias="review_score"))(
    lambda spark, d: P.value_counts(raw(spark, d)["order_reviews"], "review_score", sort="value"))
register("p08_late_share", _vc_sql("is_delayed", "stg_orders", normalize=True,
                                   alias="is_delayed"))(
    lambda spark, d: P.value_counts(stg(spark, d, "stg_orders"), "is_delayed", normalize=True))

register("p09_orders_per_month", _vc_sql("strftime(order_purchase_timestamp, '%Y-%m')",
                                         "raw_orders", by_value=True, alias="purchase_month"))(
    lambda spark, d: P.orders_per_month(raw(spark, d)["orders"]))

TRANSLATION_CTE = """
translation AS (
  SELECT DISTINCT product_category_name,
    CASE WHEN product_category_name = 'large_xl' THEN 'large'
         ELSE product_category_name END || '_en' AS product_category_name_english
  FROM raw_products
  WHERE product_category_name IS NOT NULL AND NOT starts_with(product_category_name, 'promo')),
item_cat AS (
  SELECT i.*, coalesce(t.product_category_name_english, 'Unknown')
           AS product_category_name_english
  FROM (SELECT i.*, coalesce(p.product_category_name, 'unknown') AS product_category_name
        FROM stg_order_items i LEFT JOIN raw_products p ON i.product_id = p.product_id) i
  LEFT JOIN translation t ON i.product_category_name = t.product_category_name)
"""


def _items_cat(spark, d):
    r = raw(spark, d)
    return r["order_items"], r["products"], translation_table(r["products"])


register("p10_item_category_ranking",
         _vc_sql("product_category_name_english", "item_cat", 10,
                 alias="product_category_name_english"), TRANSLATION_CTE)(
    lambda spark, d: P.item_category_ranking(*_items_cat(spark, d)))
register("p10_item_category_pairs",
         "SELECT DISTINCT product_category_name, product_category_name_english FROM item_cat",
         TRANSLATION_CTE)(lambda spark, d: P.item_category_pairs(*_items_cat(spark, d)))

register("p11_catalogue_category_ranking", _vc_sql(
    "coalesce(t.product_category_name_english, p.product_category_name)",
    "(SELECT coalesce(product_category_name, 'unknown') AS product_category_name "
    "FROM raw_products) p LEFT JOIN translation t "
    "ON p.product_category_name = t.product_category_name", 10, alias="category_display"),
         TRANSLATION_CTE)(
    lambda spark, d: P.catalogue_category_ranking(raw(spark, d)["products"],
                                                  translation_table(raw(spark, d)["products"])))

# ---- P12 - P18 -----------------------------------------------------------------

_c, _s = histogram_sql(clip_sql("price", None, 200), "stg_order_items", 40)
register("p12_price_histogram", _s, _c)(
    lambda spark, d: P.price_histogram(raw(spark, d)["order_items"]))

_hs = []
_hc = []
for _i, _col in enumerate(["seller_processing_days", "carrier_transit_days"]):
    c_, s_ = histogram_sql(clip_sql(_col, 0, 20), "stg_orders", 40, prefix=f"h{_i}")
    _hc.append(c_)
    _hs.append(s_.replace("SELECT CAST(r.i", f"SELECT '{_col}' AS column_name, CAST(r.i", 1))
register("p13_stage_histograms", "\nUNION ALL\n".join(_hs), ",".join(_hc))(
    lambda spark, d: P.stage_histograms(stg(spark, d, "stg_orders")))

_c, _s = histogram_sql(clip_sql("delay_days", -10, 20), "stg_orders", 40)
register("p14_delay_histogram", _s, _c)(
    lambda spark, d: P.delay_histogram(stg(spark, d, "stg_orders")))


def _reduction_sql(n: str) -> str:
    return (f"SELECT '{n}' AS table_name, b.n AS rows_before, a.n AS rows_after, "
            f"b.n - a.n AS rows_dropped, "
            f"round((b.n - a.n) / b.n * CAST(100 AS DOUBLE), 2) AS pct_removed "
            f"FROM (SELECT count(*) AS n FROM {RAW_SQL[n]}) b, "
            f"(SELECT count(*) AS n FROM {STAGING_OF[n]}) a")


register("p15_geo_reduction", _reduction_sql("geolocation"))(
    lambda spark, d: C.reduction_report(raw(spark, d)["geolocation"],
                                        stg(spark, d, "stg_geolocation"), "geolocation"))

KEYS = [("orders", ["order_id"]), ("order_items", ["order_id", "order_item_id"]),
        ("customers", ["customer_id"]), ("sellers", ["seller_id"]),
        ("geolocation", ["geolocation_zip_code_prefix"]), ("products", ["product_id"]),
        ("order_reviews", ["review_id"])]


def _keys_sql(n: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return (f"SELECT '{n}' AS table_name, '{','.join(keys)}' AS key, count(*) AS duplicate_keys, "
            f"CAST(coalesce(sum(c), 0) AS BIGINT) AS rows_with_duplicate_key "
            f"FROM (SELECT count(*) AS c FROM {RAW_SQL[n]} GROUP BY {k} HAVING count(*) > 1)")


register("p16_key_uniqueness", "\nUNION ALL\n".join(_keys_sql(n, k) for n, k in KEYS))(
    lambda spark, d: _union([P.key_uniqueness(raw(spark, d)[n], k, n) for n, k in KEYS]))

register("p17_date_order_check", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS earlier, '{b}' AS later, count_if({b} < {a}) AS violations FROM raw_orders"
    for a, b in P.DATE_ORDER))(lambda spark, d: P.date_order_check(raw(spark, d)["orders"]))

register("p18_delivery_outliers", """
SELECT order_id, actual_delivery_days, round(lo, 4) AS lower_fence, round(hi, 4) AS upper_fence
FROM fact CROSS JOIN (
  SELECT q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lo, q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS hi
  FROM (SELECT quantile_cont(actual_delivery_days, 0.25) AS q1,
               quantile_cont(actual_delivery_days, 0.75) AS q3 FROM fact))
WHERE actual_delivery_days < lo OR actual_delivery_days > hi""")(
    lambda spark, d: P.delivery_outliers(fact(spark, d)))

# ---- C15 - C17 -----------------------------------------------------------------

register("c15_negative_audit", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count_if({r} < 0) AS negative_count FROM od"
    for c, r in [("approval_time_days", "approval_raw"),
                 ("seller_processing_days", "processing_raw"),
                 ("carrier_transit_days", "transit_raw"), ("delay_days", "delay_days")]))(
    lambda spark, d: C.negative_audit(C.orders_before_clipping(raw(spark, d)["orders"])))

register("c16_reduction_report", "\nUNION ALL\n".join(_reduction_sql(n) for n in RAW_NAMES))(
    lambda spark, d: _union([C.reduction_report(df, stg(spark, d, STAGING_OF[n]), n)
                             for n, df in raw(spark, d).items()]))

STAGING_COLUMNS = {
    "stg_orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
                   "order_approved_at", "order_delivered_carrier_date",
                   "order_delivered_customer_date", "order_estimated_delivery_date",
                   "approval_time_days", "seller_processing_days", "carrier_transit_days",
                   "actual_delivery_days", "delay_days", "is_delayed"],
    "stg_products": ["product_id", "product_category_name", "product_name_lenght",
                     "product_description_lenght", "product_photos_qty", "product_weight_g",
                     "product_length_cm", "product_height_cm", "product_width_cm"],
    "stg_order_reviews": ["review_id", "order_id", "review_score", "review_creation_date",
                          "review_answer_timestamp"],
}


def _remaining_sql() -> str:
    parts = []
    for t, cols in STAGING_COLUMNS.items():
        for c in cols:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                         f"count_if({c} IS NULL) AS missing_count FROM {t}")
    return "SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") WHERE missing_count > 0"


register("c17_remaining_missing", _remaining_sql())(
    lambda spark, d: _union([C.remaining_missing(stg(spark, d, t))
                             .select(F.lit(t).alias("table_name"), "*")
                             for t in STAGING_COLUMNS]))

# ---- J9 - J15 ------------------------------------------------------------------

register("j09_fact_input_order", """
SELECT wide.* EXCLUDE (item_product_id, item_seller_id, geolocation_zip_code_prefix, lat, lng),
  item_product_id AS product_id, item_seller_id AS seller_id, lat AS customer_lat, lng AS customer_lng,
  stg_products.product_category_name, stg_products.product_weight_g,
  seller_city, seller_state, seller_zip_code_prefix
FROM wide LEFT JOIN stg_products ON stg_products.product_id = item_product_id
LEFT JOIN stg_sellers ON stg_sellers.seller_id = item_seller_id""")(
    lambda spark, d: J.build_fact_pandas_order(warehouse_for(spark, d).staging(),
                                               "order_item_id"))

register("j10_slim_fact", """
SELECT * EXCLUDE (price, freight_value, item_product_id, item_seller_id, customer_city) FROM wide""")(
    lambda spark, d: J.slim_fact(stg(spark, d, "stg_orders"), stg(spark, d, "stg_customers"),
                                 stg(spark, d, "stg_geolocation"),
                                 stg(spark, d, "stg_order_reviews")).select(
        *[F.col(c) for c in STAGING_COLUMNS["stg_orders"]], "review_score", "customer_state",
        "customer_zip_code_prefix", "geolocation_zip_code_prefix", "lat", "lng"))

register("j11_fact_items", """
SELECT f.order_id, oi.product_id AS i_product_id, p.product_category_name AS p_category
FROM fact f JOIN stg_order_items oi ON f.order_id = oi.order_id
JOIN stg_products p ON oi.product_id = p.product_id""")(
    lambda spark, d: J.items_with_products(fact(spark, d), stg(spark, d, "stg_order_items"),
                                           stg(spark, d, "stg_products"))
    .select("order_id", "i_product_id", "p_category"))

register("j12_fact_seller_customer", """
SELECT f.order_id, f.seller_id, f.customer_id, s.seller_state AS s_state,
  c.customer_state AS c_state
FROM fact f JOIN stg_sellers s ON f.seller_id = s.seller_id
JOIN stg_customers c ON f.customer_id = c.customer_id""")(
    lambda spark, d: J.fact_with_seller_customer(fact(spark, d), stg(spark, d, "stg_sellers"),
                                                 stg(spark, d, "stg_customers"))
    .select("order_id", "seller_id", "customer_id", "s_state", "c_state"))

ORPHANS = [("order_items.product_id -> products", "stg_order_items", "product_id",
            "stg_products", "product_id"),
           ("order_items.seller_id -> sellers", "stg_order_items", "seller_id",
            "stg_sellers", "seller_id"),
           ("orders.customer_id -> customers", "stg_orders", "customer_id",
            "stg_customers", "customer_id"),
           ("order_reviews.order_id -> orders", "stg_order_reviews", "order_id",
            "stg_orders", "order_id"),
           ("customers.zip -> geolocation", "stg_customers", "customer_zip_code_prefix",
            "stg_geolocation", "geolocation_zip_code_prefix")]

register("j15_orphan_keys", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS relation, count(*) AS orphan_rows FROM {ct} x "
    f"WHERE x.{ck} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {pt} y WHERE y.{pk} = x.{ck})"
    for name, ct, ck, pt, pk in ORPHANS))(
    lambda spark, d: _union([J.orphan_keys(stg(spark, d, ct), stg(spark, d, pt), ck, pk, name)
                             for name, ct, ck, pt, pk in ORPHANS]))

# ---- C12 / C13: geolocation per zip ---------------------------------------------

register("c12_geolocation_mean", """
SELECT geolocation_zip_code_prefix, lat, lng, city, state FROM stg_geolocation""")(
    lambda spark, d: C.clean_geolocation(raw(spark, d)["geolocation"], strategy="mean_rounded"))

register("c13_geolocation_first", """
SELECT geolocation_zip_code_prefix, geolocation_lat AS lat, geolocation_lng AS lng,
  geolocation_city AS city, geolocation_state AS state
FROM (SELECT *, row_number() OVER (PARTITION BY geolocation_zip_code_prefix
        ORDER BY geolocation_lat, geolocation_lng, geolocation_city, geolocation_state) AS rn
      FROM raw_geolocation)
WHERE rn = 1""")(
    lambda spark, d: C.clean_geolocation(raw(spark, d)["geolocation"], strategy="first"))
