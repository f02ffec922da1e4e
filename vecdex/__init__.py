"""vecdex: build, store and query text-embedding indexes with Spark.

Layout
------
functions/   Column -> Column helpers (text rules, vector math)
sources/     readers for raw corpora (TSV, archives) and the test tables
operators/   DataFrame -> DataFrame operators (corpus build, embedders, index,
             exact and approximate top-k search, enrichment)
plans/       the registered query catalogue and plan-inspection helpers
streaming/   Structured Streaming jobs (search, incremental ingest, debounce,
             rate control)
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
