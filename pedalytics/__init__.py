"""Trip-history analytics on Spark: ingest, star schema, reports and load audit."""
