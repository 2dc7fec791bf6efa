"""Column expressions. Everything here is built from Spark SQL functions."""
