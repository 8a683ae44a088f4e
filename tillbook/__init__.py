"""Retail sale transactions on Spark: ingest, versioned tables, reports and quality gates."""
