"""Spark operators for geographic feature tables: ingest, measures, conflation, change detection, networks and data quality."""
