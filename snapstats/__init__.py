"""Growth tracking for published media, expressed as Spark DataFrame jobs."""
