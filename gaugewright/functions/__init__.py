"""Column functions; all of them stay inside Spark's built-in expressions."""
