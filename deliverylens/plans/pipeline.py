"""Raw inputs -> seven staging tables -> fact -> quality gate -> publication.

One Spark application. Each staging table is written once (full refresh) and
read back, so the fact's plan starts from Parquet scans instead of
re-running the cleaning lineage, and a lost executor recomputes from files
in the shared folder rather than from the raw inputs.

Nothing is scanned for the reports: rows read and written, negative durations,
remaining NULLs and the quality gate's counts are observed by the jobs that
write. Readers see the refresh when its manifest is published, after the gate.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession

from deliverylens.operators.analysis import rollup
from deliverylens.operators.clean import CLEANERS, clean_all
from deliverylens.operators.fact import build_fact
from deliverylens.operators.quality import assert_counts, quality_counts
from deliverylens.sources.raw import read_raw_tables
from deliverylens.sources.schemas import RAW_TABLES
from deliverylens.sources.sinks import FACT_TABLE, fresh_months, load_fact, write_fact, write_months, write_staging
from deliverylens.sources.snapshots import Snapshots

STAGING_TABLES = ("stg_orders", "stg_order_items", "stg_customers", "stg_sellers",
                  "stg_geolocation", "stg_products", "stg_order_reviews")


def run_concurrently(tasks: dict[str, Callable[[], object]], max_workers: int = 8) -> dict:
    """Submit independent Spark jobs from a small thread pool.

    Each task is one or a few jobs over its own inputs (e.g. one staging
    table). Submitted together, the scheduler interleaves their tasks, so
    small jobs stop queueing behind each other and a cluster is not left idle
    between jobs. The first failure is re-raised.
    """
    if not tasks:
        return {}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        futures = {name: pool.submit(fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}


@dataclass
class Warehouse:
    """A published snapshot, kept while the object lives; ``table(name)`` reads
    one of its tables. ``checks``: the quality gate's; ``audit``: what was
    observed during the load (C15-C17, C16 as rows before and after)."""

    spark: SparkSession
    root: str
    checks: list = field(default_factory=list)
    manifest: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.manifest = self.manifest or Snapshots(self.spark, self.root).manifest()

    @property
    def audit(self) -> dict:
        return self.manifest["audit"]

    def table(self, name: str) -> DataFrame:
        """A staging table, ``fact``, or ``rollup``: the fact's mergeable sums by month, state and seller."""
        if name in ("fact", "rollup"):
            entry = self.manifest["tables"][FACT_TABLE if name == "fact" else name]
            return load_fact(self.spark, self.root, entry)
        return Snapshots(self.spark, self.root).read(self.manifest["tables"][name])

    @property
    def fact(self) -> DataFrame:
        return self.table("fact")

    def staging(self) -> dict[str, DataFrame]:
        return {t: self.table(t) for t in STAGING_TABLES}

    def raw(self) -> dict[str, DataFrame]:
        """The raw zone (bound inputs as written), if the warehouse has one."""
        return {n: self.spark.read.parquet(os.path.join(self.root, "raw", n))
                for n in RAW_TABLES}

    def reduction(self) -> DataFrame:
        """C16 as observed: rows before and after cleaning, a row a table."""
        rows = [(raw, e["before"], e["after"]) for raw, e in sorted(self.audit["rows"].items())]
        return self.spark.createDataFrame(rows, "table_name string, rows_before long, rows_after long").selectExpr(
            "*", "rows_before - rows_after AS rows_dropped",
            "round(try_divide(rows_before - rows_after, rows_before) * 100D, 2) AS pct_removed")


def run_pipeline(spark: SparkSession, raw: dict[str, DataFrame] | str, out_dir: str,
                 enforce_quality: bool = True, unmatched: str = "null", incremental: bool = False) -> Warehouse:
    """Clean, load, build, check and publish. ``raw`` is a folder of the seven
    CSVs or a dict of DataFrames (e.g. from ``sources.binding.raw_tables``). Any
    failure raises and leaves the published snapshot as it was; with
    ``enforce_quality`` a failed check raises ``ValueError``. ``incremental``
    keeps the files of the fact's months that have not changed."""
    if isinstance(raw, str):
        raw = read_raw_tables(spark, raw)
    shots = Snapshots(spark, out_dir)
    version, before = shots.begin(), shots.manifest()["tables"]
    observed = {name: Observation(f"{name} read") for name in [*CLEANERS, "negative"]}
    written = {stg: Observation(f"{stg} written") for stg in STAGING_TABLES}
    staged = clean_all(raw, observed)
    tables = run_concurrently({t: (lambda t=t, df=df: write_staging(df, out_dir, t, version, written[t]))
                               for t, df in staged.items()})
    fact = build_fact({t: shots.read(e) for t, e in tables.items()}, unmatched=unmatched)
    gate = Observation("quality")
    entry = write_fact(fact, out_dir, version, before.get(FACT_TABLE) if incremental else None,
                       [(gate, quality_counts())])
    tables[FACT_TABLE] = entry
    tables["rollup"] = write_months(rollup(load_fact(spark, out_dir, fresh_months(entry, version))), "rollup", out_dir,
                                    version, entry, before.get("rollup"))
    fresh = any(m["path"].endswith(f"v={version}") for m in entry["months"].values())
    counts = _with_kept_months(dict(gate.get) if fresh or not incremental else {}, entry, version)
    checks = assert_counts(counts) if enforce_quality else []
    after = {stg: dict(o.get) for stg, o in written.items()}
    audit = {"rows": {name: {"before": observed[name].get["rows"], "after": after[stg]["rows"]}
                      for name, (stg, _) in CLEANERS.items()},
             "negative": dict(observed["negative"].get),
             "missing": {stg: {c: n for c, n in seen.items() if c != "rows" and n} for stg, seen in after.items()}}
    shots.publish(tables, audit)
    return Warehouse(spark, out_dir, checks)


def _with_kept_months(counts: dict[str, int], entry: dict, version: str) -> dict[str, int]:
    """The gate's counts for the whole fact: months that keep their files passed
    the gate when they were written, so only their rows are added."""
    kept = sum(m["rows"] for m in entry["months"].values() if not m["path"].endswith(f"v={version}"))
    names = ("row_count", "empty_order_id", "negative_delivery", "invalid_score", "invalid_flag")
    out = {c: counts.get(c) or 0 for c in names}
    out["row_count"] += kept
    return out
