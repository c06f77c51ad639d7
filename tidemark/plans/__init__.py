"""The clean and report pipelines end to end, and the messages they read from the given tables."""
