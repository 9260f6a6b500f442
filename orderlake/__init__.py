"""Order analytics on Spark: incremental loads, quality checks, customer and revenue tables."""
