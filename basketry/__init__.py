"""Commerce analytics as lazy Spark DataFrame jobs."""
