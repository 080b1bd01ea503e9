"""Shop analytics on Spark: ingest, staging, normalized layer, marts and checks."""
