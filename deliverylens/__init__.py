"""deliverylens: delivery / SLA analytics as Spark DataFrame operators.

Layout
------
sources/    raw-table readers, fixture binding, staging / fact sinks
functions/  column-expression helpers (rates, buckets, calendar, translation)
operators/  cleaning, fact build, dashboard KPIs, analysis, profiling,
            quality gate, geographic layers
plans/      the end-to-end pipeline and the warehouse the queries read
"""

__version__ = "0.1.0"
