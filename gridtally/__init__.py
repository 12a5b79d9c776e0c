"""Interval-reading analytics as plain Spark DataFrame operators."""
