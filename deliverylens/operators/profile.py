"""Table profiling (P1-P18): shape, types, missing values, duplicates,
describe, head, value counts, category rankings, histograms and checks.

Each profile is an aggregation over the table (one pass per metric family,
never a collect of rows); per-column results are unpivoted to long format.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deliverylens.functions.translate import translate_codes
from deliverylens.operators.distribution import box_stats, describe, histogram, histograms, value_counts
from deliverylens.operators.quantiles import exact_quantiles


def shape(df: DataFrame, name: str) -> DataFrame:
    """Rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("columns"))


def missing_values(df: DataFrame, name: str | None = None) -> DataFrame:
    """Per column, NULL count and % of rows; only columns with NULLs."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot(["_rows"], cols, "column_name", "missing_count")
    out = (long.filter(F.col("missing_count") > 0)
           .select("column_name", "missing_count",
                   F.round(F.col("missing_count") * F.lit(100.0) / F.col("_rows"), 2)
                   .alias("missing_pct")))
    if name is not None:
        out = out.select(F.lit(name).alias("table_name"), "*")
    return out


#: Words of 64 bits in the filter of suspected duplicates (at most that many rows are broadcast).
FILTER_WORDS = 1 << 16


def _fingerprints(df: DataFrame) -> DataFrame:
    """The rows with ``_a`` and ``_b``, two 64-bit hashes of all columns; where
    NULLs stand is hashed too, as a hash of columns skips them."""
    nulls = F.concat_ws("", *[F.col(f"`{c}`").isNull().cast("int") for c in df.columns])
    cols = [F.col(f"`{c}`") for c in df.columns]
    return df.select("*", F.xxhash64(nulls, *cols).alias("_a"), F.xxhash64(F.lit("b"), *reversed(cols), nulls).alias("_b"))


def repeated_rows(df: DataFrame) -> DataFrame:
    """Each row that occurs more than once, with its number ``_n``.

    Rows are counted by fingerprint, 24 bytes each, after map-side combining.
    Fingerprints met more than once set bits in a filter of fixed size, which is
    broadcast; only rows that pass it, the suspects, are shuffled whole and
    compared by all their columns, so neither a collision nor the filter's false
    alarms can count as a duplicate, and no duplicate can pass it by.
    """
    hashed = _fingerprints(df)
    twice = hashed.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    word, bit = f"pmod(_a, {FILTER_WORDS})", f"shiftleft(1L, cast(pmod(_b, 64) AS int))"
    words = twice.groupBy(F.expr(word).alias("_word")).agg(F.expr(f"bit_or({bit})").alias("_bits"))
    suspects = (hashed.join(F.broadcast(words), F.expr(f"{word} = _word"))
                .where(F.expr(f"(_bits & {bit}) <> 0")).select(*[f"`{c}`" for c in df.columns]))
    return (suspects.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))


def duplicate_rows(df: DataFrame, name: str) -> DataFrame:
    """Full-row duplicates (occurrences after the first) and their %."""
    dups = repeated_rows(df).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("dups"))
    total = df.agg(F.count(F.lit(1)).alias("rows"))
    return total.crossJoin(F.broadcast(dups)).select(
        F.lit(name).alias("table_name"), F.col("dups").cast("long").alias("duplicate_rows"),
        F.round(F.expr("try_divide(dups * 100D, rows)"), 2).alias("duplicate_pct"))


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def describe_numeric(df: DataFrame, name: str | None = None) -> DataFrame:
    """P5: describe() of the numeric columns."""
    cols = numeric_columns(df)
    out = describe(df, cols)
    return out.select(F.lit(name).alias("table_name"), "*") if name else out


def head(df: DataFrame, n: int = 5, order: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows by an explicit order (default: all columns)."""
    return df.orderBy(*(order or df.columns)).limit(n)


def profile_dataset(df: DataFrame, name: str, full: bool = True) -> DataFrame:
    """P1 to P6 of a table in long format (table_name, column_name, metric,
    value): rows, columns, duplicate rows and their share; per column its type,
    missing values and their share; and unless ``full`` is false describe() of the
    numeric columns and the first five rows (``head_1`` to ``head_5``). All
    values as text."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    both = one.crossJoin(F.broadcast(duplicate_rows(df, name).select("duplicate_rows", "duplicate_pct")))
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def cell(column: str | None, metric: str, value: str) -> str:
        return (f"struct({'cast(NULL AS string)' if column is None else repr(column)} AS column_name, "
                f"{metric!r} AS metric, cast({value} AS string) AS value)")

    cells = [cell(None, "rows", "_rows"), cell(None, "columns", str(len(cols))),
             cell(None, "duplicate_rows", "duplicate_rows"), cell(None, "duplicate_pct", "duplicate_pct")]
    for i, c in enumerate(cols):
        cells += [cell(c, "dtype", repr(types[c])), cell(c, "missing_count", f"_m{i}"),
                  cell(c, "missing_pct", f"round(try_divide(_m{i} * 100D, _rows), 2)")]
    out = both.select(F.expr(f"inline(array({', '.join(cells)}))"))
    if not full:
        return out.select(F.lit(name).alias("table_name"), "column_name", "metric", "value")
    if numeric_columns(df):
        stats = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
        d = describe(df, numeric_columns(df)).select("column_name", *[F.col(s).cast("double").alias(s) for s in stats])
        out = out.unionByName(d.unpivot(["column_name"], stats, "metric", "value").withColumn(
            "value", F.col("value").cast("string")))
    order = F.row_number().over(Window.orderBy(*[F.asc_nulls_first(f"`{c}`") for c in cols]))  # of five rows
    numbered = head(df).select(F.concat(F.lit("head_"), order).alias("metric"),
                               *[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    out = out.unionByName(numbered.unpivot(["metric"], cols, "column_name", "value"))
    return out.select(F.lit(name).alias("table_name"), "column_name", "metric", "value")


def orders_per_month(orders: DataFrame) -> DataFrame:
    """Orders per purchase month (text yyyy-MM), all statuses, by month."""
    from deliverylens.operators.clean import to_timestamp_col
    m = F.date_format(to_timestamp_col(orders, "order_purchase_timestamp"), "yyyy-MM")
    return value_counts(orders.select(m.alias("purchase_month")), "purchase_month", sort="value")


def item_categories(items: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    """P10 base: each item with its category code ('unknown' when missing or
    unmatched) and English name ('Unknown' when untranslated)."""
    p = products.select(F.col("product_id").alias("_pid"), "product_category_name")
    j = (items.join(p, F.col("product_id") == F.col("_pid"), "left").drop("_pid")
         .fillna({"product_category_name": "unknown"}))
    return translate_codes(j, "product_category_name", translation,
                           "product_category_name_english", fallback="constant",
                           constant="Unknown")


def _counted_by_code(rows: DataFrame, products: DataFrame | None) -> DataFrame:
    """Rows counted by category code ('unknown' when missing or unmatched).

    ``rows`` with a product id are counted by product before they meet the
    products, and by code before the code is translated, so neither a hot product
    nor one of the few codes is a shuffle key for rows."""
    if products is None:
        return rows.fillna({"product_category_name": "unknown"}).groupBy("product_category_name").agg(
            F.count(F.lit(1)).alias("count"))
    p = products.select(F.col("product_id").alias("_pid"), "product_category_name")
    per_product = rows.groupBy("product_id").agg(F.count(F.lit(1)).alias("_n"))
    return (per_product.join(p, F.col("product_id") == F.col("_pid"), "left")
            .fillna({"product_category_name": "unknown"})
            .groupBy("product_category_name").agg(F.sum("_n").alias("count")))


def _ranked(counts: DataFrame, label: str, top: int) -> DataFrame:
    """``value_counts`` of rows that are counted by something finer already."""
    return (counts.where(F.col(label).isNotNull()).groupBy(label).agg(F.sum("count").alias("count"))
            .orderBy(F.desc("count"), F.asc(label)).limit(top))


def item_category_ranking(items: DataFrame, products: DataFrame, translation: DataFrame,
                          top: int = 10) -> DataFrame:
    """P10: top item categories by English name."""
    label = "product_category_name_english"
    counts = translate_codes(_counted_by_code(items, products), "product_category_name", translation, label,
                             fallback="constant", constant="Unknown")
    return _ranked(counts, label, top)


def item_category_pairs(items: DataFrame, products: DataFrame, translation: DataFrame
                        ) -> DataFrame:
    """P10: distinct (code, English name) pairs seen on items; the codes are
    distinct before they are translated."""
    counts = translate_codes(_counted_by_code(items, products), "product_category_name", translation,
                             "product_category_name_english", fallback="constant", constant="Unknown")
    return counts.select("product_category_name", "product_category_name_english")


def catalogue_category_ranking(products: DataFrame, translation: DataFrame,
                               top: int = 10) -> DataFrame:
    """Top catalogue categories, English name or the original code."""
    counts = translate_codes(_counted_by_code(products, None), "product_category_name", translation,
                             "category_display", fallback="original")
    return _ranked(counts, "category_display", top)


def price_histogram(items: DataFrame, bins: int = 40, hi: float = 200.0) -> DataFrame:
    """Item price clipped above at 200, 40 bins."""
    from deliverylens.operators.clean import to_double_col
    return histogram(items.select(to_double_col(items, "price").alias("price")), "price", bins,
                     None, hi)


def stage_histograms(orders: DataFrame, bins: int = 40, lo: float = 0.0, hi: float = 20.0,
                     stages: Sequence[str] = ("seller_processing_days", "carrier_transit_days")
                     ) -> DataFrame:
    """Processing and transit histograms clipped to 0..20, 40 bins each, in two scans."""
    return histograms(orders, list(stages), bins, lo, hi)


def delay_histogram(orders: DataFrame, bins: int = 40) -> DataFrame:
    """Delay clipped to -10..20, 40 bins."""
    return histogram(orders, "delay_days", bins, -10, 20)


def key_uniqueness(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Keys occurring more than once and the rows they cover."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return g.agg(F.count(F.lit(1)).alias("duplicate_keys"),
                 F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows_with_duplicate_key")
                 ).select(F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key"),
                          "duplicate_keys", "rows_with_duplicate_key")


# Timestamp pairs that must not run backwards (earlier, later).
DATE_ORDER = [("order_purchase_timestamp", "order_approved_at"),
              ("order_approved_at", "order_delivered_carrier_date"),
              ("order_delivered_carrier_date", "order_delivered_customer_date"),
              ("order_purchase_timestamp", "order_delivered_customer_date")]


def date_order_check(orders: DataFrame) -> DataFrame:
    """Rows where a later timestamp precedes an earlier one, per pair."""
    one = orders.agg(*[F.count_if(F.col(b) < F.col(a)).alias(f"{a}>{b}") for a, b in DATE_ORDER])
    names = [f"{a}>{b}" for a, b in DATE_ORDER]
    rows = F.array(*[F.struct(F.lit(a).alias("earlier"), F.lit(b).alias("later"),
                              F.col(f"`{n}`").alias("violations"))
                     for (a, b), n in zip(DATE_ORDER, names)])
    return one.select(F.inline(rows))


def delivery_outliers(fact: DataFrame, col: str = "actual_delivery_days",
                      whisker: float = 1.5) -> DataFrame:
    """Rows beyond the IQR fences of ``col`` (fences from one-row
    quartiles joined as a broadcast; output is distributed, not collected)."""
    q = exact_quantiles(fact, [col], [0.25, 0.75], prefix="_q_").select(
        F.col(f"_q_{col}").alias("q"))
    fences = q.select((F.col("q")[0] - whisker * (F.col("q")[1] - F.col("q")[0])).alias("lo"),
                      (F.col("q")[1] + whisker * (F.col("q")[1] - F.col("q")[0])).alias("hi"))
    j = fact.crossJoin(F.broadcast(fences))
    return (j.filter((F.col(col) < F.col("lo")) | (F.col(col) > F.col("hi")))
            .select("order_id", col, F.round("lo", 4).alias("lower_fence"),
                    F.round("hi", 4).alias("upper_fence")))


def delivery_box(fact: DataFrame) -> DataFrame:
    """P18 companion: box statistics of the total delivery time."""
    return box_stats(fact, ["actual_delivery_days"])
