"""Column functions. All are built-in Spark expressions; none starts a Python worker."""
