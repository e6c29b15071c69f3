"""Market and macro time-series analytics as Spark DataFrame jobs."""
