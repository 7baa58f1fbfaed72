import os

from deliverylens.operators import clean as C
from deliverylens.sources.raw import read_raw
from deliverylens.sources.schemas import RAW_COLUMNS
from tests.conftest import rows

ORDER_HEADER = ",".join(RAW_COLUMNS["orders"])


def _write_csv(path, name, header, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, f"{name}.csv"), "w") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")


def test_read_raw_is_text_and_clean_orders(spark, tmp_path):
    d = str(tmp_path / "raw")
    _write_csv(d, "orders", ORDER_HEADER, [
        # delivered at the estimate: on time; approval one hour before purchase: clipped
        "o1,c1,delivered,2024-01-01 10:00:00,2024-01-01 09:00:00,2024-01-02 09:00:00,"
        "2024-01-05 10:00:00,2024-01-05 10:00:00",
        # late by one day
        "o2,c1,delivered,2024-01-01 10:00:00,2024-01-01 11:00:00,2024-01-02 11:00:00,"
        "2024-01-06 10:00:00,2024-01-05 10:00:00",
        # unparsable approval -> NULL -> dropped
        "o3,c2,delivered,2024-01-01 10:00:00,not a date,2024-01-02 11:00:00,"
        "2024-01-06 10:00:00,2024-01-05 10:00:00",
        # not delivered -> dropped
        "o4,c2,shipped,2024-01-01 10:00:00,2024-01-01 11:00:00,2024-01-02 11:00:00,"
        "2024-01-06 10:00:00,2024-01-05 10:00:00",
    ])
    raw = read_raw(spark, d, "orders")
    assert all(t == "string" for _, t in raw.dtypes)
    out = C.clean_orders(raw).orderBy("order_id")
    got = rows(out, "order_id", "approval_time_days", "delay_days", "is_delayed")
    assert got == [("o1", 0.0, 0.0, 0), ("o2", 1 / 24, 1.0, 1)]
    audit = dict(rows(C.negative_audit(C.orders_before_clipping(raw))))
    assert audit["approval_time_days"] == 1 and audit["delay_days"] == 0


def test_review_scores_outside_range_become_null(spark):
    raw = spark.createDataFrame(
        [("r1", "o1", "0", None, None, "2024-01-01 00:00:00", None),
         ("r2", "o1", "6", None, None, None, None),
         ("r3", "o2", "5", "t", "m", "bad", None),
         ("r4", None, "4", None, None, None, None)],
        ",".join(f"{c} string" for c in RAW_COLUMNS["order_reviews"]))
    out = C.clean_order_reviews(raw).orderBy("review_id")
    assert "review_comment_title" not in out.columns
    assert rows(out, "review_id", "review_score", "review_creation_date") == [
        ("r1", None, __import__("datetime").datetime(2024, 1, 1)), ("r2", None, None),
        ("r3", 5, None)]


def test_products_fill_unknown_and_drop_missing_dimensions(spark):
    cols = RAW_COLUMNS["products"]
    raw = spark.createDataFrame(
        [("p1", None, "3.0", "x", None, "100", "1", "1", "1"),
         ("p2", "audio", "1", "2", "3", None, "1", "1", "1")],
        ",".join(f"{c} string" for c in cols))
    out = C.clean_products(raw)
    assert rows(out, "product_id", "product_category_name", "product_name_lenght",
                "product_description_lenght") == [("p1", "unknown", 3, None)]


def test_geolocation_strategies(spark):
    cols = RAW_COLUMNS["geolocation"]
    raw = spark.createDataFrame(
        [("01001", "-23.1", "-46.1", "b", "SP"), ("01001", "-23.2", "-46.3", "a", "SP"),
         ("02000", "1.0", "2.0", "c", "RJ")], ",".join(f"{c} string" for c in cols))
    mean = C.clean_geolocation(raw).orderBy("geolocation_zip_code_prefix")
    assert rows(mean) == [("01001", -23.15, -46.2, "a", "SP"), ("02000", 1.0, 2.0, "c", "RJ")]
    first = C.clean_geolocation(raw, strategy="first").orderBy("geolocation_zip_code_prefix")
    assert rows(first, "lat", "city") == [(-23.2, "a"), (1.0, "c")]
    stripped = C.to_text(raw, ["geolocation_zip_code_prefix"], strip_leading_zeros=True)
    assert sorted(r[0] for r in rows(stripped, "geolocation_zip_code_prefix")) == [
        "1001", "1001", "2000"]


def test_reduction_and_remaining_missing(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (3, "y"), (4, None)], "k int, v string")
    b = a.filter("k > 1")
    assert rows(C.reduction_report(a, b, "t")) == [("t", 4, 3, 1, 25.0)]
    assert rows(C.remaining_missing(b)) == [("v", 1)]
