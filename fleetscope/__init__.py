"""Fleet-telemetry analytics as Spark DataFrame, SQL and Structured Streaming jobs."""
