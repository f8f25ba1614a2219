"""Column functions built from Spark SQL expressions."""
