"""Column functions built only from Spark expressions."""
