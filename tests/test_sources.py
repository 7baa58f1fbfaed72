from pathlib import Path

from pyspark.sql import functions as F

from deliverylens.functions.translate import read_translation_csv, translate_codes
from deliverylens.operators import geo
from deliverylens.operators.fact import build_fact
from deliverylens.plans import text_queries
from deliverylens.plans.warehouse import write_raw_zone
from deliverylens.sources import binding as B
from deliverylens.sources.sinks import export_layers
from deliverylens.sources.snapshots import Snapshots
from tests.conftest import SF_SMALL, rows
from tests.fixtures import staging


def test_translation_csv_lookup_with_fallbacks(spark, tmp_path):
    path = tmp_path / "category_translation.csv"
    path.write_text("product_category_name,product_category_name_english\n"
                    "beleza_saude,health_beauty\nautomotivo,auto\n")
    t = read_translation_csv(spark, str(path))
    df = spark.createDataFrame([("beleza_saude",), ("novo_codigo",)], "product_category_name string")
    out = translate_codes(df, "product_category_name", t, "en", fallback="constant")
    assert sorted(rows(out, "en")) == [("Unknown",), ("health_beauty",)]
    out = translate_codes(df, "product_category_name", t, "en", fallback="original")
    assert sorted(rows(out, "en")) == [("health_beauty",), ("novo_codigo",)]


def test_export_layers_round_trip(spark, tmp_path):
    f = build_fact(staging(spark))
    layers = {"state": geo.state_markers(f), "points": geo.heat_points(f, min_orders=1)}
    out = str(tmp_path / "layers")
    export_layers(layers, out)
    shots = Snapshots(spark, out)
    back = shots.read(shots.manifest()["tables"]["state"])
    assert back.count() == layers["state"].count() and "color" in back.columns
    export_layers({"points": layers["points"]}, out, fmt="json")
    tables = shots.manifest()["tables"]
    assert shots.read(tables["points"], "json").agg(F.sum("weight")).first()[0] >= 0
    assert shots.read(tables["state"]).count() == back.count()


def test_marker_tiers_and_radius(spark):
    df = spark.createDataFrame([(4.99, 100), (5.0, 4000), (39.9, 20000), (40.0, 1)],
                               "r double, n long")
    got = rows(df.select(geo.delay_label("r"), geo.delay_color("r"), geo.marker_radius("n")))
    assert got == [("Sangat Baik", "#1a9641", 8.0), ("Baik", "#a6d96a", 8.0),
                   ("Bermasalah", "#fdae61", 30.0), ("Kritis", "#d7191c", 8.0)]


def test_raw_orders_from_the_numbered_items(spark, tmp_path):
    src = {n: B.read_source(spark, SF_SMALL, n) for n in ("orders", "lineitem", "customer")}
    raw = write_raw_zone(spark, SF_SMALL, str(tmp_path / "w"))
    plain = B.raw_orders(**src)
    assert raw["orders"].count() == plain.count() == src["orders"].count()
    assert raw["orders"].exceptAll(plain).count() == 0
    first = B.first_line_supplier(src["lineitem"])
    assert B.first_item_supplier(raw["order_items"]).exceptAll(first).count() == 0
    assert not (tmp_path / "w" / "_items_ranged").exists()   # no hot order
    assert list((tmp_path / "w" / "raw" / "orders").glob("*.zstd.parquet"))


def test_a_text_table_is_written_when_it_is_read(spark):
    text_queries._ZONES.clear()
    n = text_queries.text(spark, SF_SMALL, "products").agg(F.count("product_id")).first()[0]
    root = Path(text_queries.text_zone(spark, SF_SMALL, []).removeprefix("file:"))
    assert [p.name for p in root.iterdir()] == ["products.csv"]
    assert list((root / "products.csv").glob("*.csv.gz"))
    assert n == B.read_source(spark, SF_SMALL, "part").count()
