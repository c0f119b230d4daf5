"""News analytics on Spark: bronze, silver and gold as DataFrame plans."""
