"""Column expressions, all built from Spark functions."""
