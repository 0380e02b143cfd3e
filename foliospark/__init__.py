"""Statement documents to tables, on Spark."""
