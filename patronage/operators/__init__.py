"""Operators: each is a DataFrame -> DataFrame function whose core is a Spark plan."""
