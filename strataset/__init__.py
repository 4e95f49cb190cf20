"""Spark engine for building, validating and exploring datasets about source code."""
