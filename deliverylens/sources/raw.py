"""Raw CSV scans with an all-text schema (no inference pass), and what they could not take in."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.sources.schemas import RAW_TABLES, raw_schema

FILE_NAMES = {name: f"{name}.csv" for name in RAW_TABLES}
#: Tables with free text, whose quoted fields may hold line breaks: their files
#: cannot be split, so a large one is best given as a folder of many files.
MULTI_LINE = {"order_reviews"}
#: Where a record that does not fit the columns is kept.
RECORD = "_record"


def read_raw(spark: SparkSession, directory: str, name: str, keep_bad: bool = False) -> DataFrame:
    """Read ``<directory>/<name>.csv`` with a header, every column as string.

    Quoted fields may hold commas and doubled quotes, and in tables of
    ``MULTI_LINE`` line breaks. Records with too few or too many fields are left
    out; with ``keep_bad`` they stay and are in the column ``RECORD`` as read,
    for ``rejects``.

    A declared schema avoids Spark's inference pass (a full extra scan at
    scale) and keeps ids and zip prefixes as text (no lost leading zeros).
    """
    if name not in FILE_NAMES:
        raise KeyError(f"unknown raw table {name!r}; expected one of {sorted(FILE_NAMES)}")
    path = os.path.join(directory, FILE_NAMES[name])
    found = (spark.read.option("header", "true").option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", RECORD).option("columnPruning", "false")  # else not judged by all fields
             .option("multiLine", str(name in MULTI_LINE).lower())
             .option("quote", '"').option("escape", '"').schema(raw_schema(name).add(RECORD, "string")).csv(path))
    return found if keep_bad else found.where(F.col(RECORD).isNull()).drop(RECORD)


def rejects(raw: DataFrame, name: str) -> DataFrame:
    """(table_name, column_name, reason, value) of what the cleaning cannot use
    of a text table read with ``keep_bad``: records that do not fit the columns,
    and texts that are no timestamp, number or integer where one is wanted (such
    a row is kept, the value becomes NULL)."""
    from deliverylens.operators.clean import CONVERSIONS

    def found(column: str | None, reason: str, value):
        return F.struct(F.lit(column).cast("string").alias("column_name"), F.lit(reason).alias("reason"),
                        value.alias("value"))

    some = F.length(F.coalesce(raw.columns[0], F.lit(""))) >= 0  # a scan of the record column alone is not allowed
    cells = [F.when(F.col(RECORD).isNotNull() & some, found(None, "record does not fit the columns", F.col(RECORD)))]
    for column, (convert, reason) in CONVERSIONS[name].items():
        bad = F.col(RECORD).isNull() & (F.trim(F.col(column)) != "") & convert(raw, column).isNull()
        cells.append(F.when(bad, found(column, reason, F.col(column))))
    return raw.select(F.explode(F.array_compact(F.array(*cells))).alias("r")).select(
        F.lit(name).alias("table_name"), "r.*")


def reject_counts(found: DataFrame) -> DataFrame:
    """Rejects by table, column and reason."""
    return found.groupBy("table_name", "column_name", "reason").agg(F.count(F.lit(1)).alias("rejected"))


def read_raw_tables(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    return {name: read_raw(spark, directory, name) for name in RAW_TABLES}
