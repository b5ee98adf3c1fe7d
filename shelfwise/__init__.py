"""Product-listing analytics on Spark: ingest, clean, model, report."""
