"""wxodds: scores weather prediction-market prices against weather observations on Spark.

Layers:
  functions/  column expressions (no DataFrame in, Column out)
  sources/    test-table loaders, derived fixtures, landing-zone scans, sinks
  operators/  DataFrame -> DataFrame steps (ingest, as-of join, accuracy, alerts, serving, quality)
  plans/      the batch flow, the query registry and the DuckDB oracle SQL
  streaming/  Structured Streaming jobs built from the same stateless functions
"""

__version__ = "0.1.0"
