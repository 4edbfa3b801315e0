"""tectonic — earthquake-catalogue analytics as lazy Spark DataFrame plans.

Layers:
  sources/    readers (text, GeoJSON, Parquet, prefix datasets, binary, JDBC) and fixtures
  functions/  column expressions (cleaning, parsing, keys, bins, geometry) — all JVM-side
  operators/  DataFrame -> DataFrame building blocks (slicing, typing, spatial join, dedup,
              aggregation helpers, upsert, data-quality checks)
  plans/      the bronze -> silver -> gold pipeline assembled from the operators
  sinks/      Parquet / JSON / binary / JDBC writers, table DDL, load metrics
  streaming/  incremental ingest of new catalogue files with Structured Streaming
"""

__version__ = "0.1.0"
