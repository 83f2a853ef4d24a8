"""Medallion analytics on Spark: ingest, clean, version, summarise and model match telemetry."""
