"""Column expressions; all are native Spark expressions."""
