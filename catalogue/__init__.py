"""Queries over the driver's test tables, and the SQL each of them must agree with."""
