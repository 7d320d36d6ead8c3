"""Dated, dimensioned count data on Spark: ingest, derive, serve."""
