"""Publication, incremental months, observed audits and rejects."""

import os

import pytest
from pyspark.sql import functions as F

from deliverylens.operators.quality import quality_report
from deliverylens.plans import pipeline
from deliverylens.plans.pipeline import Warehouse, run_pipeline
from deliverylens.plans.warehouse import warehouse_for
from deliverylens.sources.raw import read_raw, reject_counts, rejects
from deliverylens.sources.sinks import FACT_TABLE
from deliverylens.sources.snapshots import Snapshots
from tests.conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def raw(spark):
    return warehouse_for(spark, SF_SMALL).raw()


def content(wh):
    return sorted(map(str, wh.fact.collect()))


def files(wh):
    """Path -> modification time of every file of the published fact."""
    out = {}
    for m in wh.manifest["tables"][FACT_TABLE]["months"].values():
        for f in os.listdir(os.path.join(wh.root, m["path"])):
            p = os.path.join(wh.root, m["path"], f)
            out[p] = os.stat(p).st_mtime_ns
    return out


def test_a_failed_refresh_leaves_the_published_tables(spark, raw, tmp_path, monkeypatch):
    root = str(tmp_path / "wh")
    first = run_pipeline(spark, raw, root)
    before = content(first)
    half = dict(raw, orders=raw["orders"].limit(100))

    def killed(*_, **__):
        raise RuntimeError("killed between two writes")

    with monkeypatch.context() as m:  # the staging tables are written, the fact is not
        m.setattr(pipeline, "write_fact", killed)
        with pytest.raises(RuntimeError, match="killed"):
            run_pipeline(spark, half, root)
    assert Snapshots(spark, root).numbers() == [1]
    again = Warehouse(spark, root)
    assert content(again) == before and again.table("stg_orders").count() == first.table("stg_orders").count()

    with pytest.raises(ValueError, match="row count"):  # the gate stops it before publication
        run_pipeline(spark, dict(raw, orders=raw["orders"].where("false")), root)
    assert content(Warehouse(spark, root)) == before

    second = run_pipeline(spark, half, root)
    assert Snapshots(spark, root).numbers() == [1, 2]
    assert second.fact.count() < len(before)
    assert content(first) == before  # a reader keeps the snapshot it opened


def test_incremental_refresh_writes_changed_months_only(spark, raw, tmp_path):
    root = str(tmp_path / "wh")
    first = run_pipeline(spark, raw, root)
    old = files(first)
    same = run_pipeline(spark, raw, root, incremental=True)
    assert files(same) == old and content(same) == content(first)
    assert same.checks == first.checks

    # one order's delivery moves, another disappears
    ids = [r[0] for r in rows(first.fact.select("order_id").orderBy("order_id").limit(2))]
    later = F.when(F.col("order_id") == ids[0], F.expr("order_delivered_customer_date + INTERVAL 1 DAY")).otherwise(
        F.col("order_delivered_customer_date"))
    changed = dict(raw, orders=raw["orders"].where(F.col("order_id") != ids[1])
                   .withColumn("order_delivered_customer_date", later))
    months = {r[0] for r in rows(first.fact.where(F.col("order_id").isin(ids)).select("purchase_ym"))}
    got = run_pipeline(spark, changed, root, incremental=True)
    full = run_pipeline(spark, changed, str(tmp_path / "full"))
    assert content(got) == content(full) and got.checks == full.checks
    untouched = {p: t for p, t in old.items() if not any(f"purchase_ym={m}/" in p for m in months)}
    assert {p: t for p, t in files(got).items() if p in old} == untouched
    assert len(untouched) < len(old)


def test_plan_of_the_write_samples_nothing(spark, raw, tmp_path):
    wh = run_pipeline(spark, raw, str(tmp_path / "wh"))
    from deliverylens.operators.fact import build_fact
    laid = build_fact(wh.staging()).withColumn("m", F.lit(1)).hint("rebalance", "m")
    assert "rangepartitioning" not in laid._jdf.queryExecution().executedPlan().toString()


def test_observed_audits_equal_the_scans(spark):
    from deliverylens.operators import clean as C

    wh = warehouse_for(spark, SF_SMALL)
    raw = wh.raw()
    assert [v for _, v in wh.checks] == [v for (v,) in rows(quality_report(wh.fact), "value")]
    for name, (stg, _) in C.CLEANERS.items():
        seen = wh.audit["rows"][name]
        assert seen == {"before": raw[name].count(), "after": wh.table(stg).count()}
        assert wh.audit["missing"][stg] == dict(rows(C.remaining_missing(wh.table(stg))))
    assert wh.audit["negative"] == dict(rows(C.negative_audit(C.orders_before_clipping(raw["orders"]))))


def test_rejects_of_a_damaged_file(spark, tmp_path):
    (tmp_path / "order_items.csv").write_text(
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s1,2024-01-01 10:00:00,10.5,1\n"
        "o2,x,p1,s1,soon,ten,\n"
        "o3,1,p1,s1\n"
        'o4,2.0,p1,s1,2024-01-02,"1,5",2,extra\n'
        "o5,2.0,\"p,1\",s1,2024-01-02,15,2\n")
    found = rejects(read_raw(spark, str(tmp_path), "order_items", keep_bad=True), "order_items")
    assert sorted(map(str, rows(reject_counts(found)))) == sorted(map(str, [
        ("order_items", "order_item_id", "not an integer", 1),
        ("order_items", "shipping_limit_date", "not a timestamp", 1),
        ("order_items", "price", "not a number", 1),
        ("order_items", None, "record does not fit the columns", 2)]))
    assert [r[0] for r in rows(read_raw(spark, str(tmp_path), "order_items"), "order_id")] == ["o1", "o2", "o5"]


def test_reviews_keep_line_breaks(spark, tmp_path):
    (tmp_path / "order_reviews.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
        'review_answer_timestamp\nr1,o1,5,"a ""quoted"" title","two\nlines, one comma",2024-01-01,2024-01-02\n')
    (got,) = rows(read_raw(spark, str(tmp_path), "order_reviews"), "review_comment_message", "review_comment_title")
    assert got == ("two\nlines, one comma", 'a "quoted" title')


def test_layers_are_published_together(spark, tmp_path):
    from deliverylens.sources.sinks import export_layers

    df = spark.range(3)
    export_layers({"a": df, "b": df}, str(tmp_path))
    shots = Snapshots(spark, str(tmp_path))
    kept = shots.manifest()
    with pytest.raises(Exception):  # the second layer fails: neither is seen
        export_layers({"a": spark.range(9), "b": df.selectExpr("raise_error('x') AS id")}, str(tmp_path))
    assert shots.manifest() == kept and shots.read(kept["tables"]["a"]).count() == 3
