"""Cases in which an easy reading of the rules gives another answer."""

import datetime as dt

from deliverylens.operators import analysis, clean, fact, quality
from deliverylens.operators.fact import apply_engine_defaults
from deliverylens.sources.raw import read_raw
from deliverylens.sources.schemas import FACT, raw_schema


def test_quoted_comments_with_breaks_and_quotes(spark, tmp_path):
    table = next(n for n in _raw_names() if "review" in n)
    names = raw_schema(table).names
    row = {n: "" for n in names} | {"review_id": "r1", "order_id": "o1", "review_score": "5"}
    first = row | {"review_comment_message": '"line one\nline two, ""more"""', "review_creation_date": "2018-01-02"}
    second = row | {"review_id": "r2", "review_comment_message": '"say ""hi"""', "review_creation_date": "2018-01-03"}
    text = ",".join(names) + "\n" + "\n".join(",".join(r[n] for n in names) for r in (first, second)) + "\n"
    (tmp_path / f"{table}.csv").write_text(text)
    got = {r["review_id"]: r for r in read_raw(spark, str(tmp_path), table).collect()}
    assert set(got) == {"r1", "r2"}
    assert got["r1"]["review_comment_message"] == 'line one\nline two, "more"'
    assert got["r1"]["review_creation_date"] == "2018-01-02" and got["r2"]["review_comment_message"] == 'say "hi"'


def _raw_names():
    from deliverylens.sources.schemas import RAW_TABLES

    return list(RAW_TABLES)


def _orders(spark, rows):
    names = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
             "order_delivered_customer_date", "order_estimated_delivery_date"]
    return spark.createDataFrame(rows, ", ".join(f"{n} timestamp_ntz" for n in names))


def test_late_by_a_fraction_of_a_second_and_without_estimate(spark):
    t = dt.datetime(2018, 5, 1, 12)
    late = t + dt.timedelta(milliseconds=800)
    df = clean.add_late_flag(clean.add_durations(_orders(spark, [(t, t, t, late, t), (t, t, t, t, t), (t, t, t, t, None)])))
    got = [(r["delay_days"], r["is_delayed"]) for r in df.collect()]
    assert got[0][1] == 1 and abs(got[0][0] * 86400 - 0.8) < 1e-9
    assert got[1] == (0.0, 0) and got[2] == (None, 0)


def test_text_nan_is_no_number(spark):
    df = spark.createDataFrame([("1.5",), ("NaN",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(clean.to_double_col(df, "v")).collect()] == [1.5, None, None, None]


def test_first_skips_null(spark):
    items = spark.createDataFrame([("o", None, "p0", "s0", 1.0, 1.0), ("o", 1, "p1", "s1", 2.0, 2.0), ("n", None, "p", "s", 1.0, 1.0)],
                                  "order_id string, order_item_id int, product_id string, seller_id string, "
                                  "price double, freight_value double")
    assert [(r["order_id"], r["product_id"]) for r in fact.first_item_per_order(items).collect()] == [("o", "p1")]
    geo = spark.createDataFrame([("1", 1.0, 1.0, None, "SP"), ("1", 1.0, 1.0, "sao", None), ("1", 1.0, 1.0, "zeta", "RJ")],
                                "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
                                "geolocation_city string, geolocation_state string")
    r = clean.aggregate_geolocation(geo).first()
    assert (r["city"], r["state"]) == ("sao", "RJ")


def _fact(spark, rows):
    """rows: dicts of a few fact columns; the others are NULL."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in FACT.fields) for r in rows], FACT)


def test_sellers_are_ranked_before_rounding(spark):
    """33.334 and 33.336 are both 33.33 or differ only after rounding up."""
    df = _fact(spark, [{"seller_id": s, "order_id": f"{s}{i}", "is_delayed": int(i < late)}
                       for s, n, late in (("a", 3000, 1000), ("b", 29998, 10000)) for i in range(n)])
    rates = {r["seller_id"]: r["delay_rate_pct"] for r in analysis.seller_profile(df, 1).collect()}
    assert rates == {"a": 33.33, "b": 33.34} or rates["a"] == rates["b"]
    assert [r["seller_id"] for r in analysis.top_sellers(df, n=1, min_orders=1).collect()] == ["b"]
    near = _fact(spark, [{"seller_id": s, "order_id": f"{s}{i}", "is_delayed": int(i < late)}
                         for s, n, late in (("a", 3, 1), ("b", 20003, 6668)) for i in range(n)])
    rates = {r["seller_id"]: r["delay_rate_pct"] for r in analysis.seller_profile(near, 1).collect()}
    assert rates["a"] == rates["b"]  # ranked by id, if rounded first
    assert analysis.top_sellers(near, 1, 1).first()["seller_id"] == "b"


def test_score_drop_subtracts_rounded_means(spark):
    rows = [{"order_id": f"o{i}", "is_delayed": 0, "review_score": s} for i, s in enumerate([5, 5, 4])]
    rows += [{"order_id": f"l{i}", "is_delayed": 1, "review_score": s} for i, s in enumerate([5, 5, 5, 5, 5, 5, 5, 5, 5, 5, 5, 6])]
    r = analysis.score_drop(_fact(spark, rows)).first()
    assert r["score_drop"] == round(round(14 / 3, 3) - round(61 / 12, 3), 3)


def test_null_flag_fails_the_gate_and_defaults_fill_coordinates(spark):
    df = _fact(spark, [{"order_id": "o", "is_delayed": None, "actual_delivery_days": 1.0}])
    failed = [r["check_name"] for r in quality.quality_report(df).collect() if not r["passed"]]
    assert failed == ["is_delayed only 0 or 1"]
    r = apply_engine_defaults(df).first()
    assert (r["customer_lat"], r["customer_lng"], r["review_score"]) == (0.0, 0.0, None)
