"""Clean-and-report on PySpark: one set of DataFrame transforms for batch and Structured Streaming."""
