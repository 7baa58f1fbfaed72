"""Per-dataset warehouse used by the registered queries.

The binding of the given tables is run through the pipeline once per
(dataset, process) and written under the session's shared checkpoint folder;
every query then reads the written staging / fact tables (column pruning and
month pruning apply), as the reference's dashboards query the loaded tables.
"""

from __future__ import annotations

import os
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

from deliverylens.plans.pipeline import Warehouse, run_concurrently, run_pipeline
from deliverylens.session import shared_dir
from deliverylens.sources.binding import raw_table_builders
from deliverylens.sources.sinks import CODEC
from deliverylens.sources.snapshots import FOLDER

_LOCK = threading.Lock()
_CACHE: dict[tuple[str, str], Warehouse] = {}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def warehouse_for(spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (os.path.abspath(sf_dir), shared_dir(spark))
    with _LOCK:
        wh = _CACHE.get(key)
        if wh is not None and _exists(spark, os.path.join(wh.root, FOLDER)):
            return Warehouse(spark, wh.root, wh.checks, wh.manifest)
        root = os.path.join(key[1], f"deliverylens-{uuid.uuid4().hex[:12]}")
        wh = build_warehouse(spark, sf_dir, root)
        _CACHE[key] = wh
        return wh


def write_raw_zone(spark: SparkSession, sf_dir: str, root: str) -> dict[str, DataFrame]:
    """Bind the given tables to the seven raw inputs once and write them under
    ``root/raw`` (the reference's raw files); returns them read back. The orders
    follow the items, whose numbering they use."""
    builders = raw_table_builders(spark, sf_dir, stage_dir=root)

    def path(name: str) -> str:
        return os.path.join(root, "raw", name)

    def write(name: str, *given: DataFrame) -> None:
        builders[name](*given).write.mode("overwrite").option("compression", CODEC).parquet(path(name))

    def write_items_and_orders() -> None:
        write("order_items")
        write("orders", spark.read.parquet(path("order_items")))

    tasks = {name: (lambda n=name: write(n)) for name in builders if name not in ("orders", "order_items")}
    run_concurrently({"order_items": write_items_and_orders} | tasks)
    return Warehouse(spark, root, manifest={"tables": {}}).raw()


def build_warehouse(spark: SparkSession, sf_dir: str, out_dir: str,
                    enforce_quality: bool = True) -> Warehouse:
    """Raw zone, staging tables and fact under ``out_dir``."""
    raw = write_raw_zone(spark, sf_dir, out_dir)
    return run_pipeline(spark, raw, out_dir, enforce_quality=enforce_quality)
