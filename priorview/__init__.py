"""Leakage-safe, as-of analytics on Spark DataFrames."""
