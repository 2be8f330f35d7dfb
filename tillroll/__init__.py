"""Retail batch analytics as plain PySpark DataFrame transformations."""
