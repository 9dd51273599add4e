"""Claims-integrity analytics as Spark DataFrame jobs."""
