"""Customer-engagement lakehouse on PySpark: ingest, typing, incremental loads,
identity resolution, enrichment and publishing."""
