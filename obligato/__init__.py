"""obligato — budget-execution ledger analytics as lazy Spark DataFrame operators.

Layout:
  functions/  Column-level helpers (text grammars, money, calendar, statistics)
  sources/    scans of ledgers, summaries, pages and text lines; sinks
  operators/  DataFrame -> DataFrame operators (pairing, rollups, profiles, quality, outliers)
  plans/      composite pipelines and the query registry used by __spark_entry__.py
  streaming/  incremental month ingestion with Structured Streaming
"""

__version__ = "0.1.0"
