"""Operators for building training data from a document corpus. Nothing else in the library imports this package."""
