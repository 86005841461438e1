"""Layered retail warehouse on Spark: clean daily extracts, subject tables, report tables."""
