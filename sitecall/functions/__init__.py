"""Column functions (built-in Spark expressions; statistics via Spark's java_method)."""
