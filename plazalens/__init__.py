"""Analytics for large dumps of social posts, as plain Spark DataFrame operators."""
