"""Column expressions: each takes columns and returns one column, without any Python UDF."""
