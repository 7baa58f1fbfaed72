"""Cleaning and feature engineering.

Every function takes and returns a DataFrame and uses only built-in column
expressions. Inputs may be raw text (CSV) or already typed (Parquet); the
converters leave typed columns alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deliverylens.functions.exprs import clip, clip_lower, days_between
from deliverylens.sources.schemas import STAGING

ORDER_TIMESTAMPS = ["order_purchase_timestamp", "order_approved_at",
                    "order_delivered_carrier_date", "order_delivered_customer_date",
                    "order_estimated_delivery_date"]
CRITICAL_ORDER_TIMESTAMPS = ["order_approved_at", "order_delivered_customer_date",
                             "order_delivered_carrier_date"]
STAGE_COLUMNS = ["approval_time_days", "seller_processing_days", "carrier_transit_days"]
DURATION_COLUMNS = STAGE_COLUMNS + ["actual_delivery_days", "delay_days"]
PRODUCT_DIMENSIONS = ["product_weight_g", "product_length_cm", "product_height_cm",
                      "product_width_cm"]
VALID_SCORES = [1, 2, 3, 4, 5]
NEGATIVE_AUDIT = STAGE_COLUMNS + ["delay_days"]


def _dtype(df: DataFrame, c: str) -> T.DataType:
    return df.schema[c].dataType


# ---- C1 / C2 / C14: tolerant type conversion ---------------------------------

def to_timestamp_col(df: DataFrame, c: str) -> Column:
    """Text -> timestamp_ntz, unparsable -> NULL (``errors='coerce'``)."""
    t = _dtype(df, c)
    if isinstance(t, T.TimestampNTZType):
        return F.col(c)
    if isinstance(t, (T.TimestampType, T.DateType)):
        return F.col(c).cast("timestamp_ntz")
    return F.expr(f"try_cast(trim(`{c}`) AS timestamp_ntz)")


def to_double_col(df: DataFrame, c: str) -> Column:
    """Text -> double, bad -> NULL (``pd.to_numeric(errors='coerce')``)."""
    if isinstance(_dtype(df, c), T.DoubleType):
        return F.col(c)
    return F.expr(f"nanvl(try_cast(`{c}` AS double), NULL)")  # text 'NaN' is no number


def to_int_col(df: DataFrame, c: str) -> Column:
    """C14: nullable integer; text such as '3.0' is accepted, '3.5' -> 3."""
    if isinstance(_dtype(df, c), T.IntegerType):
        return F.col(c)
    return F.expr(f"try_cast(try_cast(`{c}` AS double) AS int)")


#: What the cleaning converts of each raw table, and what a text is not that fails.
_TIME, _NUMBER, _INT = ((to_timestamp_col, "not a timestamp"), (to_double_col, "not a number"),
                        (to_int_col, "not an integer"))
CONVERSIONS = {
    "orders": dict.fromkeys(ORDER_TIMESTAMPS, _TIME),
    "order_items": {"order_item_id": _INT, "shipping_limit_date": _TIME, "price": _NUMBER, "freight_value": _NUMBER},
    "customers": {}, "sellers": {},
    "geolocation": dict.fromkeys(["geolocation_lat", "geolocation_lng"], _NUMBER),
    "products": dict.fromkeys(["product_name_lenght", "product_description_lenght", "product_photos_qty"], _INT)
    | dict.fromkeys(PRODUCT_DIMENSIONS, _NUMBER),
    "order_reviews": {"review_score": _NUMBER}
    | dict.fromkeys(["review_creation_date", "review_answer_timestamp"], _TIME),
}


def coerce_timestamps(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: to_timestamp_col(df, c) for c in cols})


def coerce_doubles(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: to_double_col(df, c) for c in cols})


def coerce_ints(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: to_int_col(df, c) for c in cols})


def to_text(df: DataFrame, cols: Iterable[str], strip_leading_zeros: bool = False) -> DataFrame:
    """Zip prefix as text. ``strip_leading_zeros`` mimics reading it as a
    number first (apply to both sides of a join or neither)."""
    out = {}
    for c in cols:
        v = F.col(c).cast("string")
        if strip_leading_zeros:
            v = F.regexp_replace(v, r"^0+(?=\d)", "")
        out[c] = v
    return df.withColumns(out)


# ---- C3 - C8, C10, C11 ------------------------------------------------------

def keep_status(df: DataFrame, status: str = "delivered") -> DataFrame:
    """C3."""
    return df.filter(F.col("order_status") == status)


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """C4."""
    return df.dropna(how="any", subset=list(subset))


def add_durations(df: DataFrame) -> DataFrame:
    """Five durations in fractional days."""
    return df.withColumns({
        "approval_time_days": days_between("order_purchase_timestamp", "order_approved_at"),
        "seller_processing_days": days_between("order_approved_at",
                                               "order_delivered_carrier_date"),
        "carrier_transit_days": days_between("order_delivered_carrier_date",
                                             "order_delivered_customer_date"),
        "actual_delivery_days": days_between("order_purchase_timestamp",
                                             "order_delivered_customer_date"),
        "delay_days": days_between("order_estimated_delivery_date",
                                   "order_delivered_customer_date"),
    })


def clip_stages(df: DataFrame, cols: Sequence[str] = tuple(STAGE_COLUMNS)) -> DataFrame:
    """Negative stage durations -> 0; total and delay are not clipped."""
    return df.withColumns({c: clip_lower(c, 0.0) for c in cols})


def add_late_flag(df: DataFrame) -> DataFrame:
    """late = delivered strictly after the estimate; without one, not late."""
    return df.withColumn("is_delayed", F.coalesce(F.col("delay_days") > 0, F.lit(False)).cast("int"))


def fill_category(df: DataFrame, value: str = "unknown") -> DataFrame:
    """C8."""
    return df.fillna({"product_category_name": value})


def drop_text_columns(df: DataFrame,
                      cols: Sequence[str] = ("review_comment_title",
                                             "review_comment_message")) -> DataFrame:
    """``drop`` ignores absent columns, like ``errors='ignore'``."""
    return df.drop(*cols)


def valid_score(c: str | Column = "review_score") -> Column:
    """C11: a score outside 1..5 becomes NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isin(*VALID_SCORES), c).cast("int")


def clip_range(df: DataFrame, c: str, lo: float | None = None, hi: float | None = None,
               out: str | None = None) -> DataFrame:
    """Display clip, one- or two-sided."""
    return df.withColumn(out or c, clip(c, lo, hi))


# ---- per-table cleaning (the DAG's load_* tasks) -----------------------------

def _conform(df: DataFrame, table: str) -> DataFrame:
    schema = STAGING[table]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def clean_orders(raw: DataFrame, negative: Observation | None = None) -> DataFrame:
    """Orders -> stg_orders: convert, keep delivered, drop rows missing a
    critical timestamp, derive durations, clip stages, flag late. ``negative``
    takes C15's counts on the way."""
    df = coerce_timestamps(raw, ORDER_TIMESTAMPS)
    df = keep_status(df)
    df = drop_missing(df, CRITICAL_ORDER_TIMESTAMPS)
    df = add_durations(df)
    if negative is not None:
        df = df.observe(negative, *[F.count_if(F.col(c) < 0).alias(c) for c in NEGATIVE_AUDIT])
    df = clip_stages(df)
    df = add_late_flag(df)
    return _conform(df, "stg_orders")


def clean_order_items(raw: DataFrame) -> DataFrame:
    df = coerce_doubles(raw, ["price", "freight_value"])
    df = coerce_timestamps(df, ["shipping_limit_date"])
    df = coerce_ints(df, ["order_item_id"])
    return _conform(df, "stg_order_items")


def clean_customers(raw: DataFrame, strip_leading_zeros: bool = False) -> DataFrame:
    return _conform(to_text(raw, ["customer_zip_code_prefix"], strip_leading_zeros),
                    "stg_customers")


def clean_sellers(raw: DataFrame, strip_leading_zeros: bool = False) -> DataFrame:
    return _conform(to_text(raw, ["seller_zip_code_prefix"], strip_leading_zeros),
                    "stg_sellers")


def aggregate_geolocation(raw: DataFrame, digits: int | None = 6,
                          strip_leading_zeros: bool = False) -> DataFrame:
    """One row per zip prefix: mean lat / lng (rounded to ``digits``, or
    unrounded with None) and a deterministic 'first' city / state (those of the
    smallest (city, state) pair that has one: Spark has no file order, and
    'first' skips NULL)."""
    df = to_text(raw, ["geolocation_zip_code_prefix"], strip_leading_zeros)
    df = coerce_doubles(df, ["geolocation_lat", "geolocation_lng"])
    lat, lng = F.avg("geolocation_lat"), F.avg("geolocation_lng")
    if digits is not None:
        lat, lng = F.round(lat, digits), F.round(lng, digits)
    pair = F.struct("geolocation_city", "geolocation_state")
    city = F.min(F.when(F.col("geolocation_city").isNotNull(), pair))
    state = F.min(F.when(F.col("geolocation_state").isNotNull(), F.struct(
        F.col("geolocation_city").isNull(), "geolocation_city", "geolocation_state")))
    return (df.groupBy("geolocation_zip_code_prefix")
            .agg(lat.alias("lat"), lng.alias("lng"), city.alias("_c"), state.alias("_s"))
            .select("geolocation_zip_code_prefix", "lat", "lng",
                    F.col("_c.geolocation_city").alias("city"),
                    F.col("_s.geolocation_state").alias("state")))


def dedupe_geolocation_first(raw: DataFrame, order_by: Sequence[str] = ("geolocation_lat",
                                                                         "geolocation_lng",
                                                                         "geolocation_city",
                                                                         "geolocation_state")
                             ) -> DataFrame:
    """Keep one row per zip, the first by ``order_by`` (the reference
    keeps the first in file order, which Spark does not have).

    Implemented as a grouped min over a struct rather than a window, so a
    zip holding a third of all rows is reduced map-side before the shuffle.
    """
    df = to_text(raw, ["geolocation_zip_code_prefix"])
    rest = [c for c in df.columns if c != "geolocation_zip_code_prefix"]
    ordered = list(order_by) + [c for c in rest if c not in order_by]
    return (df.groupBy("geolocation_zip_code_prefix")
            .agg(F.min(F.struct(*ordered)).alias("_f"))
            .select("geolocation_zip_code_prefix", *[F.col(f"_f.{c}").alias(c) for c in rest]))


def clean_geolocation(raw: DataFrame, strategy: str = "mean_rounded",
                      strip_leading_zeros: bool = False) -> DataFrame:
    """Geolocation -> stg_geolocation; ``strategy`` in mean_rounded (the DAG),
    mean (notebook / map), first (profiling notebook)."""
    if strategy == "mean_rounded":
        return _conform(aggregate_geolocation(raw, 6, strip_leading_zeros), "stg_geolocation")
    if strategy == "mean":
        return _conform(aggregate_geolocation(raw, None, strip_leading_zeros), "stg_geolocation")
    if strategy == "first":
        d = dedupe_geolocation_first(coerce_doubles(raw, ["geolocation_lat", "geolocation_lng"]))
        return _conform(d.select("geolocation_zip_code_prefix",
                                 F.col("geolocation_lat").alias("lat"),
                                 F.col("geolocation_lng").alias("lng"),
                                 F.col("geolocation_city").alias("city"),
                                 F.col("geolocation_state").alias("state")), "stg_geolocation")
    raise ValueError("strategy must be mean_rounded, mean or first")


def clean_products(raw: DataFrame) -> DataFrame:
    df = fill_category(raw)
    df = coerce_doubles(df, PRODUCT_DIMENSIONS)
    df = drop_missing(df, PRODUCT_DIMENSIONS)
    df = coerce_ints(df, ["product_name_lenght", "product_description_lenght",
                          "product_photos_qty"])
    return _conform(df, "stg_products")


def clean_order_reviews(raw: DataFrame) -> DataFrame:
    df = drop_text_columns(raw)
    df = coerce_timestamps(df, ["review_creation_date", "review_answer_timestamp"])
    df = df.withColumn("review_score", valid_score(to_double_col(df, "review_score")))
    df = drop_missing(df, ["review_id", "order_id"])
    return _conform(df, "stg_order_reviews")


CLEANERS = {
    "orders": ("stg_orders", clean_orders),
    "order_items": ("stg_order_items", clean_order_items),
    "customers": ("stg_customers", clean_customers),
    "sellers": ("stg_sellers", clean_sellers),
    "geolocation": ("stg_geolocation", clean_geolocation),
    "products": ("stg_products", clean_products),
    "order_reviews": ("stg_order_reviews", clean_order_reviews),
}


def clean_all(raw: dict[str, DataFrame], observed: dict[str, Observation] | None = None) -> dict[str, DataFrame]:
    """The seven staging tables. ``observed`` takes, while they are written, the
    rows read of each raw table (by its name) and C15's counts ("negative")."""
    out = {}
    for name, (stg, fn) in CLEANERS.items():
        df, more = raw[name], {}
        if observed is not None:
            df = df.observe(observed[name], F.count(F.lit(1)).alias("rows"))
            more = {"negative": observed["negative"]} if name == "orders" else {}
        out[stg] = fn(df, **more)
    return out


# ---- C15 - C17: audits ------------------------------------------------------

def negative_audit(orders_with_durations: DataFrame,
                   cols: Sequence[str] = tuple(NEGATIVE_AUDIT)) -> DataFrame:
    """Rows with a negative value per column, before clipping.
    One aggregation pass, then unpivoted to (column_name, negative_count)."""
    agg = orders_with_durations.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in cols])
    return agg.unpivot([], list(cols), "column_name", "negative_count")


def orders_before_clipping(raw_orders: DataFrame) -> DataFrame:
    """Orders converted, filtered and with durations, not yet clipped."""
    df = coerce_timestamps(raw_orders, ORDER_TIMESTAMPS)
    df = drop_missing(keep_status(df), CRITICAL_ORDER_TIMESTAMPS)
    return add_durations(df)


def reduction_report(before: DataFrame, after: DataFrame, table: str) -> DataFrame:
    """Rows before, after, dropped and % removed (two counts, one row)."""
    b = before.agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.agg(F.count(F.lit(1)).alias("rows_after"))
    return (b.crossJoin(F.broadcast(a))
            .select(F.lit(table).alias("table_name"), "rows_before", "rows_after",
                    (F.col("rows_before") - F.col("rows_after")).alias("rows_dropped"),
                    F.round(F.try_divide(F.col("rows_before") - F.col("rows_after"),
                                         F.col("rows_before")) * F.lit(100.0), 2)
                    .alias("pct_removed")))


def remaining_missing(df: DataFrame) -> DataFrame:
    """C17: columns that still hold NULLs after cleaning (column, count)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = agg.unpivot([], df.columns, "column_name", "missing_count")
    return long.filter(F.col("missing_count") > 0)
