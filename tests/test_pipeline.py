import os

from pyspark.sql import functions as F

from deliverylens.operators.quality import quality_report
from deliverylens.plans.pipeline import run_pipeline
from deliverylens.sources.binding import raw_tables
from deliverylens.sources.schemas import FACT_COLUMNS, RAW_COLUMNS
from tests.conftest import SF_SMALL, rows


def _explain(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pipeline_from_csv_is_idempotent_and_prunes(spark, tmp_path):
    # write the bound raw tables as text CSVs, as the reference receives them
    raw_dir = str(tmp_path / "raw")
    for name, df in raw_tables(spark, SF_SMALL).items():
        out = df.select(*[F.col(c).cast("string") for c in RAW_COLUMNS[name]])
        out.coalesce(1).write.mode("overwrite").option("header", True).csv(
            os.path.join(raw_dir, f"{name}.csv"))
    out_dir = str(tmp_path / "wh")
    wh = run_pipeline(spark, raw_dir, out_dir)
    fact = wh.fact
    assert fact.count() == 1004
    assert [c for c in fact.columns if c != "purchase_ym"] == FACT_COLUMNS
    first = sorted(rows(fact.select(*FACT_COLUMNS)))

    # same result on a re-run into the same folder (full refresh)
    wh2 = run_pipeline(spark, raw_dir, out_dir)
    assert sorted(rows(wh2.fact.select(*FACT_COLUMNS))) == first
    assert rows(quality_report(wh2.fact), "value")[0] == (1004,)

    # month partitions on disk, and a month filter prunes them
    parts = [p for p in os.listdir(os.path.join(out_dir, "fact_operational_delivery"))
             if p.startswith("purchase_ym=")]
    assert len(parts) > 12
    plan = _explain(wh2.fact.filter("purchase_ym = 199901").select("order_id"))
    assert "PartitionFilters: [isnotnull(purchase_ym" in plan
    assert "ReadSchema: struct<order_id:string>" in plan


def test_typed_and_text_inputs_give_same_fact(spark, tmp_path):
    typed = run_pipeline(spark, raw_tables(spark, SF_SMALL), str(tmp_path / "a"),
                         enforce_quality=False)
    assert typed.fact.count() == 1004
