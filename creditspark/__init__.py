"""Credit-risk analytics as PySpark DataFrame operators."""
