"""Column functions: text, number, loan-list and date expressions, all built-in Spark functions."""
