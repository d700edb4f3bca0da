"""Column expressions used by the operators; all are built-in Spark functions."""
