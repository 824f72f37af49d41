"""Registry files to a common company model, as Spark DataFrame jobs."""
