"""Scalar building blocks: each function takes and returns Spark Columns."""
