"""Event-sequence cohorts with free-text notes, as Spark DataFrame, SQL and ML jobs."""
