"""Keyed daily-series processing on Spark: DataFrames in, lazy DataFrames out."""
