"""Registered queries of the text path (S1, S2, C1, C2, C14), of what it rejects,
and of published tables (W1, S9).

A bound raw table is written once per dataset, when a query first reads it, as the
CSV files that the reference receives (compressed), some values damaged by rule
(``DAMAGE``), and read back as text. The damage is the same in the oracle SQL.
"""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.functions.translate import read_translation_csv
from deliverylens.operators import clean as C
from deliverylens.operators import geo as G
from deliverylens.plans.oracle import avgd, avgx, r2, rate_div
from deliverylens.plans.pipeline import STAGING_TABLES, run_concurrently
from deliverylens.plans.profile_queries import RAW_NAMES, RAW_SQL, TRANSLATION_CTE
from deliverylens.plans.registry import fact, register, warehouse_for
from deliverylens.session import shared_dir
from deliverylens.sources.binding import translation_table
from deliverylens.sources.raw import read_raw, reject_counts, rejects
from deliverylens.sources.schemas import RAW_COLUMNS, STAGING
from deliverylens.sources.sinks import export_layers
from deliverylens.sources.snapshots import Snapshots

#: table -> column -> (rows that are damaged, what stands there instead).
DAMAGE = {
    "orders": {"order_approved_at": ("CAST(order_id AS BIGINT) % 53 = 0", "'soon'"),
               "order_estimated_delivery_date": ("CAST(order_id AS BIGINT) % 59 = 1", "'2001-13-01 00:00:00'")},
    "order_items": {"price": ("CAST(product_id AS BIGINT) % 61 = 0", "'ten'"),
                    "freight_value": ("CAST(product_id AS BIGINT) % 67 = 2", "'NaN'"),
                    "order_item_id": ("CAST(seller_id AS BIGINT) % 71 = 3", "'first'")},
    "products": {"product_photos_qty": ("CAST(product_id AS BIGINT) % 7 = 3", "'2.0'"),
                 "product_name_lenght": ("CAST(product_id AS BIGINT) % 73 = 4", "'long'")},
}
TRANSLATION = "category_translation"
_LOCK = threading.Lock()
#: (dataset, shared folder) -> root, and the tables that are written there.
_ZONES: dict[tuple[str, str], tuple[str, set[str]]] = {}


def text_zone(spark: SparkSession, sf_dir: str, names: Sequence[str] = (*RAW_NAMES, TRANSLATION)) -> str:
    """The folder of a dataset's CSV files; those of ``names`` are written on first use."""
    key = (os.path.abspath(sf_dir), shared_dir(spark))
    with _LOCK:
        root, written = _ZONES.setdefault(key, (os.path.join(key[1], f"text-{uuid.uuid4().hex[:12]}"), set()))
        missing = [n for n in names if n not in written]
        raw = warehouse_for(spark, sf_dir).raw() if missing else {}

        def write(name: str) -> None:
            if name == TRANSLATION:
                out = translation_table(raw["products"])
            else:
                cells = {c: F.col(c).cast("string") for c in RAW_COLUMNS[name]}
                for c, (rows, value) in DAMAGE.get(name, {}).items():
                    cells[c] = F.when(F.expr(f"{rows} AND {c} IS NOT NULL"), F.expr(value)).otherwise(cells[c])
                out = raw[name].select(*[v.alias(c) for c, v in cells.items()])
            out.write.mode("overwrite").option("header", True).option("escape", '"').option(
                "compression", "gzip").csv(f"{root}/{name}.csv")

        run_concurrently({n: (lambda n=n: write(n)) for n in missing})
        written.update(missing)
        return root


def text(spark: SparkSession, d: str, name: str, keep_bad: bool = False) -> DataFrame:
    return read_raw(spark, text_zone(spark, d, [name]), name, keep_bad)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def filled_cells(df: DataFrame, name: str) -> DataFrame:
    """(table_name, rows, column_name, filled): what a text scan found."""
    one = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in df.columns])
    return one.unpivot(["rows"], df.columns, "column_name", "filled").select(F.lit(name).alias("table_name"), "*")


register("s01_text_scan", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, count(*) AS rows, '{c}' AS column_name, count({c}) AS filled FROM {RAW_SQL[n]}"
    for n in RAW_NAMES for c in RAW_COLUMNS[n]))(
    lambda spark, d: _union([filled_cells(text(spark, d, n), n) for n in RAW_NAMES]))

register("s02_translation_csv", "SELECT * FROM translation", TRANSLATION_CTE)(
    lambda spark, d: read_translation_csv(spark, f"{text_zone(spark, d, [TRANSLATION])}/{TRANSLATION}.csv"))


def _bad(table: str, column: str) -> str:
    return f"({DAMAGE[table][column][0]})"


register("c01_text_timestamps", "SELECT order_id, " + ", ".join(
    f"CASE WHEN {_bad('orders', c)} THEN NULL ELSE {c} END AS {c}" if c in DAMAGE["orders"] else c
    for c in C.ORDER_TIMESTAMPS) + " FROM raw_orders")(
    lambda spark, d: C.coerce_timestamps(text(spark, d, "orders"), C.ORDER_TIMESTAMPS)
    .select("order_id", *C.ORDER_TIMESTAMPS))

register("c02_text_numbers", "SELECT order_id, product_id, seller_id, " + ", ".join(
    f"CASE WHEN {_bad('order_items', c)} THEN NULL ELSE {c} END AS {c}" for c in ("price", "freight_value"))
         + " FROM stg_order_items")(
    lambda spark, d: C.coerce_doubles(text(spark, d, "order_items"), ["price", "freight_value"])
    .select("order_id", "product_id", "seller_id", "price", "freight_value"))

register("c14_text_integers", f"""
SELECT product_id, CASE WHEN {_bad('products', 'product_name_lenght')} THEN NULL ELSE product_name_lenght END
    AS product_name_lenght, product_description_lenght,
  CASE WHEN {_bad('products', 'product_photos_qty')} AND product_photos_qty IS NOT NULL THEN 2 ELSE product_photos_qty END AS product_photos_qty
FROM raw_products""")(
    lambda spark, d: C.coerce_ints(text(spark, d, "products"), [
        "product_name_lenght", "product_description_lenght", "product_photos_qty"])
    .select("product_id", "product_name_lenght", "product_description_lenght", "product_photos_qty"))

_REASONS = {C.to_timestamp_col: "not a timestamp", C.to_double_col: "not a number", C.to_int_col: "not an integer"}
register("s01_rejects", "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{_REASONS[C.CONVERSIONS[t][c][0]]}' AS reason, "
    f"count(*) AS rejected FROM {RAW_SQL[t]} WHERE {rows} AND {c} IS NOT NULL"
    for t, cells in DAMAGE.items() for c, (rows, value) in cells.items() if value != "'2.0'")
         + ") WHERE rejected > 0")(
    lambda spark, d: reject_counts(_union([rejects(text(spark, d, n, keep_bad=True), n) for n in RAW_NAMES])))

# ---- W1 and S9: what was published ----------------------------------------------

register("w01_published_tables", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows, {len(STAGING[t].fields)} AS columns FROM {t}"
    for t in STAGING_TABLES) + "\nUNION ALL\nSELECT 'fact', count(*), 29 FROM fact")(
    lambda spark, d: _union([
        warehouse_for(spark, d).table(t).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(t).alias("table_name"), "rows",
            F.lit(len([c for c in warehouse_for(spark, d).table(t).columns if c != "purchase_ym"])).alias("columns"))
        for t in (*STAGING_TABLES, "fact")]))

register("w01_published_months", """
SELECT CAST(year(order_purchase_timestamp) * 100 + month(order_purchase_timestamp) AS INTEGER) AS purchase_ym,
  count(*) AS rows, count(DISTINCT order_id) AS orders, count(seller_id) AS sold, CAST(sum(is_delayed) AS BIGINT) AS late
FROM fact GROUP BY ALL""")(
    lambda spark, d: fact(spark, d).groupBy("purchase_ym").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("order_id").alias("orders"),
        F.count("seller_id").alias("sold"), F.sum("is_delayed").alias("late")))

register("w01_observed_reduction", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, b.n AS rows_before, a.n AS rows_after, b.n - a.n AS rows_dropped, "
    f"round((b.n - a.n) / b.n * CAST(100 AS DOUBLE), 2) AS pct_removed "
    f"FROM (SELECT count(*) AS n FROM {RAW_SQL[n]}) b, (SELECT count(*) AS n FROM {C.CLEANERS[n][0]}) a"
    for n in RAW_NAMES))(lambda spark, d: warehouse_for(spark, d).reduction())


def _exported(spark: SparkSession, d: str) -> DataFrame:
    """G1's layer written, published and read back."""
    out = os.path.join(shared_dir(spark), f"layers-{uuid.uuid4().hex[:12]}")
    export_layers({"states": G.state_layer(fact(spark, d))}, out)
    shots = Snapshots(spark, out)
    return shots.read(shots.manifest()["tables"]["states"])


register("s09_exported_layer", f"""
SELECT customer_state, count(*) AS total_orders, {r2(rate_div('is_delayed = 1'))} AS delay_rate_pct,
  round({avgd('actual_delivery_days')}, 2) AS avg_delivery_days,
  round({avgd('carrier_transit_days')}, 2) AS avg_carrier_days,
  round(avg(review_score), 2) AS avg_review_score,
  round({avgx('customer_lat')}, 4) AS lat, round({avgx('customer_lng')}, 4) AS lng
FROM fact WHERE customer_lat IS NOT NULL AND customer_lng IS NOT NULL GROUP BY customer_state""")(_exported)
