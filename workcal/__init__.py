"""Business-day analytics on layered lake tables, as plain Spark DataFrame jobs."""
