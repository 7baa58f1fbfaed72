"""Sinks: snapshot tables, the month-partitioned fact and map layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from deliverylens.functions.exprs import yyyymm
from deliverylens.sources.schemas import (
    FACT, FACT_PARTITION_COLUMN, FACT_SORT, STAGING, STAGING_SORT,
)
from deliverylens.sources.snapshots import Snapshots

FACT_TABLE = "fact_operational_delivery"
#: Of all tables that a refresh writes.
CODEC = "zstd"


def conform(df: DataFrame, schema) -> DataFrame:
    """Exactly the declared columns, in order, with declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_table(df: DataFrame, path: str, sort: Sequence[str] | None = None) -> None:
    """Full refresh into a folder of its own. Rows are sorted within each
    task by the table's key so Parquet row-group statistics prune key lookups."""
    out = df.sortWithinPartitions(*sort) if sort else df
    out.write.mode("errorifexists").option("compression", CODEC).parquet(path)


def write_staging(df: DataFrame, root: str, table: str, version: str, observed: Observation | None = None) -> dict:
    """One staging table of a version; its manifest entry. ``observed`` takes
    the rows written and the NULLs left in each column."""
    out = conform(df, STAGING[table])
    if observed is not None:
        out = out.observe(observed, F.count(F.lit(1)).alias("rows"),
                          *[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in STAGING[table].fields])
    path = f"{table}/v={version}"
    write_table(out, f"{root}/{path}", STAGING_SORT[table])
    return {"path": path}


def month_sums(fact: DataFrame) -> dict[str, dict]:
    """Rows and the exact sum of the rows' hashes of each month (one row a
    month is collected): equal sums, equal months."""
    hashed = F.xxhash64(*[f.name for f in FACT.fields],
                        F.concat_ws("", *[F.col(f.name).isNull().cast("int") for f in FACT.fields]))
    rows = (fact.groupBy(F.coalesce(F.col(FACT_PARTITION_COLUMN).cast("string"), F.lit("none")).alias("month"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(hashed.cast("decimal(38,0)")).cast("string").alias("s")).collect())
    return {r["month"]: {"rows": r["n"], "sum": r["s"]} for r in rows}


def write_fact(fact: DataFrame, root: str, version: str, before: dict | None = None,
               observed: Sequence[tuple[Observation, list]] = ()) -> dict:
    """The month-partitioned, key-sorted fact of a version; its manifest entry.

    With the entry ``before``, months whose sums are unchanged keep their files
    and only the others are written. ``rebalance`` sizes the write tasks by what
    they got (a busy month is split, small ones share a task) without sampling
    the joins below. ``observed``: observations of the rows written.
    """
    out = conform(fact, FACT).withColumn(FACT_PARTITION_COLUMN, yyyymm("order_purchase_timestamp"))
    kept: dict[str, dict] = {}
    if before:
        sums = month_sums(out)
        kept = {m: e for m, e in before["months"].items()
                if sums.get(m) == {"rows": e["rows"], "sum": e["sum"]}}
        month = F.coalesce(F.col(FACT_PARTITION_COLUMN).cast("string"), F.lit("none"))
        out = out.where(~month.isin(*kept)) if kept else out
    schema = out.schema
    laid = out.hint("rebalance", FACT_PARTITION_COLUMN).sortWithinPartitions(FACT_PARTITION_COLUMN, *FACT_SORT)
    for seen, metrics in observed:
        laid = laid.observe(seen, *metrics)
    spark = fact.sparkSession
    if not before or set(sums) - set(kept):
        (laid.withColumn("v", F.lit(version)).write.mode("append").option("compression", CODEC)
         .partitionBy(FACT_PARTITION_COLUMN, "v").parquet(f"{root}/{FACT_TABLE}"))
    if not before:
        base = f"{root}/{FACT_TABLE}"
        sums = month_sums(spark.read.schema(schema.add("v", "string")).parquet(base).where(F.col("v") == version))

    def folder(m: str) -> str:
        value = "__HIVE_DEFAULT_PARTITION__" if m == "none" else m
        return f"{FACT_TABLE}/{FACT_PARTITION_COLUMN}={value}/v={version}"

    fresh = {m: {"path": folder(m), **s} for m, s in sums.items() if m not in kept}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in FACT.fields)
    return {"base": FACT_TABLE, "months": kept | fresh,
            "schema": f"{ddl}, {FACT_PARTITION_COLUMN} int, v string"}


def fresh_months(entry: dict, version: str) -> dict:
    """The entry of the months alone that ``version`` wrote."""
    return entry | {"months": {m: e for m, e in entry["months"].items() if e["path"].endswith(f"v={version}")}}


def write_months(df: DataFrame, name: str, root: str, version: str, fact: dict, before: dict | None) -> dict:
    """A table kept by the fact's months, given for the months that ``version``
    wrote; the others keep their files of ``before``."""
    fresh = fresh_months(fact, version)["months"]
    if fresh:
        (df.withColumn("v", F.lit(version)).write.mode("append").option("compression", CODEC)
         .partitionBy(FACT_PARTITION_COLUMN, "v").parquet(f"{root}/{name}"))
    months = {m: {"path": e["path"].replace(FACT_TABLE, name, 1)} if m in fresh else before["months"][m]
              for m, e in fact["months"].items()}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != FACT_PARTITION_COLUMN)
    return {"base": name, "months": months, "schema": f"{ddl}, {FACT_PARTITION_COLUMN} int, v string"}


def load_fact(spark: SparkSession, root: str, entry: dict) -> DataFrame:
    """The prepared fact. Filters on ``purchase_ym`` prune folders;
    filters on the raw timestamp need the month filter added to prune."""
    if not entry["months"]:
        return spark.createDataFrame([], entry["schema"]).drop("v")
    return Snapshots(spark, root).read(entry)


def export_layers(layers: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> int:
    """Map layers as files (the reference renders them to HTML), published
    together; ``Snapshots(spark, out_dir)`` reads them. Layers of an earlier
    export that are not given stay."""
    spark = next(iter(layers.values())).sparkSession
    shots = Snapshots(spark, out_dir)
    version, tables = shots.begin(), shots.manifest()["tables"]
    for name, df in layers.items():
        df.write.format(fmt).save(f"{out_dir}/{name}/v={version}")
        tables[name] = {"path": f"{name}/v={version}", "format": fmt}
    return shots.publish(tables)
