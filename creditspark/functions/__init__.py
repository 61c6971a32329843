"""Column expressions: every function takes and returns Spark columns."""
