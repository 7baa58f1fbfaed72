"""Benchmark: warehouse build + every registered query, one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

``w01_warehouse_build`` = raw binding -> 7 staging tables -> month-partitioned fact,
written under the session's checkpoint folder; ``w02_fact_build`` = the fact's joins
alone, from the written staging tables. Each query is then run to completion (into
the ``noop`` sink, all columns) on the written tables; the reported
time is the median of ``BENCH_REPEAT`` warm runs (default 1 warm run after
one untimed warm-up of the session).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from deliverylens.operators.fact import build_fact  # noqa: E402
from deliverylens.plans import registry  # noqa: E402
from deliverylens.plans.warehouse import _CACHE, build_warehouse  # noqa: E402
from deliverylens.session import get_spark, shared_dir  # noqa: E402

def _run(name, fn, spark, sf_dir):
    """To completion, every row and column (nothing is pruned, nothing collected)."""
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    only = [s for s in os.environ.get("BENCH_ONLY", "").split(",") if s]
    spark = get_spark("deliverylens-bench", cores=cpus, shuffle_partitions=int(cpus) * 2)
    out_root = os.path.join(shared_dir(spark), f"bench-{os.getpid()}-{int(time.time())}")
    # warm the JVM (class loading, codegen) so the first timing is not start-up
    spark.range(200000).selectExpr("id % 97 AS k").groupBy("k").count().collect()

    t = time.perf_counter()
    wh = build_warehouse(spark, sf_dir, out_root)
    pipeline_sec = time.perf_counter() - t
    _CACHE[(os.path.abspath(sf_dir), shared_dir(spark))] = wh

    timings = {"w01_warehouse_build": round(pipeline_sec, 3)}
    t = time.perf_counter()
    build_fact(wh.staging()).write.format("noop").mode("overwrite").save()
    timings["w02_fact_build"] = round(time.perf_counter() - t, 3)
    qs = registry.queries()
    for name, fn in qs.items():
        if only and not any(o in name for o in only):
            continue
        _run(name, fn, spark, sf_dir)  # warm-up (plan + JIT)
        runs = []
        for _ in range(repeat):
            t = time.perf_counter()
            _run(name, fn, spark, sf_dir)
            runs.append(time.perf_counter() - t)
        timings[name] = round(statistics.median(runs), 3)
    total = round(sum(timings.values()), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "warehouse_build_plus_all_queries", "value": total, "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus,
                      "n_queries": len(timings) - 2}))
    spark.stop()


if __name__ == "__main__":
    main()
